import random
from collections import Counter, defaultdict

from vigil.llm import common, linededup


def brute(rows, min_support=linededup.MIN_SUPPORT, similarity=linededup.SIMILARITY):
    """Dropped masked lines with every leaf in memory, without splitting."""
    holders, copies = defaultdict(set), Counter()
    for i, t in rows:
        for line in {tuple(linededup.mask(x)) for x in (t or "").split("\n")}:
            if len(line) >= linededup.MIN_TOKENS:
                holders[line].add(i if i is not None else t)
                copies[line] += 1
    support = {line: copies[line] if len(own) > 1 else 1 for line, own in holders.items()}
    leaves = defaultdict(list)
    for parts in holders:
        leaves[len(parts), parts[:linededup.DEPTHS[0]]].append(parts)
    gone = set()
    for lines in leaves.values():
        found = []
        for parts in sorted(lines, key=lambda p: (-support[p], list(p))):
            best, score = None, 0
            for f in found:
                same = sum(a == b for a, b in zip(f[0], parts, strict=True))
                if same > score:
                    best, score = f, same
            if best and score >= similarity * len(parts):
                best[0] = [a if a == b else linededup.WILD for a, b in zip(best[0], parts, strict=True)]
                best[1].append(parts)
            else:
                found.append([list(parts), [parts]])
        for _, members in found:
            if sum(support[m] for m in members) >= min_support and len(set().union(*(holders[m] for m in members))) > 1:
                gone |= set(members)
    return gone


def cleaned(rows, gone):
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if tuple(linededup.mask(x)) not in gone]
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in df.collect())


LOGS = [(k, f"User u{k} logged in from host {k}\nunique words for document {chr(97 + k)} here {chr(98 + k)} {chr(99 + k)}\nshort line\n"
            f"Please contact {name} about this matter soon") for k, name in enumerate(["anna", "bert", "carl", "dora", "emil"])]


def test_templates_recur_across_documents(frame):
    got = {r.doc_id: r for r in linededup.drop_recurring(frame(LOGS)).collect()}
    for k, _ in LOGS:
        assert got[k].n_dropped == 2 and "short line" in got[k].text and "logged" not in got[k].text and "Please" not in got[k].text
    forms = {r.template for r in linededup.recurring(frame(LOGS)).collect()}
    assert forms == {"User <*> logged in from host <*>", "Please contact <*> about this matter soon"}


def test_one_document_is_not_recurring(frame):
    text = "the same long line here again\n" * 9 + "a b c d e\na b c d f\na b c d g"
    assert linededup.drop_recurring(frame([(1, text), (2, "x")])).where("n_dropped > 0").count() == 0
    assert linededup.drop_recurring(frame([(1, text), (1, text), (1, text)])).where("n_dropped > 0").count() == 0


def test_repeated_rows_count_beside_another_document(frame):
    rows = [(1, "the same long line here"), (1, "the same long line here"), (2, "the same long line here")]
    got = rows_of(linededup.drop_recurring(frame(rows)))
    assert got == cleaned(rows, brute(rows)) and all(r[3] == 1 for r in got)


def test_documents_match_brute_force(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = brute(rows)
    assert gone
    assert rows_of(linededup.drop_recurring(docs)) == cleaned(rows, gone)


def test_crowded_leaves_split(frame):
    rows = [(k, "\n".join(f"one two {chr(97 + j % 7)} {chr(97 + k % 5)}x filler word{chr(97 + j)} end" for j in range(12))) for k in range(6)]
    whole = {(r.doc_id, r.n_dropped) for r in linededup.drop_recurring(frame(rows), leaf_rows=3).collect()}
    assert len(whole) == 6  # deeper leaves, no failure; equal lines still meet
    same = [(k, "alpha beta gamma delta epsilon\n" + f"own {k}") for k in range(4)]
    assert linededup.drop_recurring(frame(same + rows), leaf_rows=1).where("n_dropped = 1 and doc_id < 4 and text like 'own%'").count() == 4


def test_odd_rows(frame, odd_rows):
    got = linededup.drop_recurring(frame(odd_rows))
    assert rows_of(got) == cleaned(odd_rows, brute(odd_rows))
    assert linededup.drop_recurring(frame([])).count() == 0


def test_crowded_leaf_keeps_its_templates(frame):
    rows = [(k, f"Please contact name{chr(97 + k // 26)}{chr(97 + k % 26)} about this matter soon") for k in range(40)]
    rows += [(50 + k, f"Please contact {x} about that thing today\nown line of document {x} only") for k, x in enumerate("abc")]
    rows += [(60 + k, "\n".join(f"one two {chr(97 + j % 7)} {chr(97 + k % 5)}x filler word{chr(97 + j)} end" for j in range(12))) for k in range(6)]
    want = cleaned(rows, brute(rows))
    assert sum(r[3] for r in want) >= 43
    for leaf_rows in (1, 3, 1000):
        assert rows_of(linededup.drop_recurring(frame(rows), leaf_rows=leaf_rows)) == want


def test_lines_one_by_one_give_the_same_templates():
    rng = random.Random(5)
    for size in (1, 2, 3, 5, 7, 10, 13, 16, 21):
        for similarity in (0.5, 0.8, 1.0):
            lines = [list(x) for x in {("a", "b", *[rng.choice(["x", "x", "x", "y", "z", linededup.WILD]) for _ in range(size - 2)])[:size] for _ in range(150)}]
            supports = [rng.choice([1, 1, 2, 5]) for _ in lines]
            forms, members = linededup.Forms(size, similarity), {}
            for k in sorted(range(len(lines)), key=lambda k: (-supports[k], lines[k])):
                members.setdefault(forms.place(lines[k]), []).append(k)
            assert [(f, members[j]) for j, f in enumerate(forms.forms)] == linededup.templates(lines, supports, similarity)


def of_query(spark, frame, tmp_path, rows):
    frame(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: r.n_dropped for r in linededup.op7_linededup(spark, str(tmp_path)).collect()}


def test_short_lines_of_the_query(spark, frame, tmp_path):
    chinese = "\u7248\u6743\u6240\u6709\u672a\u7ecf\u8bb8\u53ef\u4e0d\u5f97\u8f6c\u8f7d"
    rows = [(k, f"All rights  reserved.\n\n{k}\nnumber {k}\nowner {chr(97 + k)}" + "\nTo to." * (k < 9) + f"\n{chinese}" * (k < 3)) for k in range(12)]
    assert of_query(spark, frame, tmp_path, rows) == {k: 1 + (k < 3) for k in range(12)}
    got = rows_of(linededup.drop_recurring(frame(rows), leaf_rows=1, short_support=10))
    assert {int(r[0]): r[3] for r in got} == {k: 1 + (k < 3) for k in range(12)}
    assert all(f"\n\n{r[0]}\nnumber {r[0]}" in "\n" + r[1] for r in got)


def test_passages_and_documents_of_the_query(spark, frame, tmp_path):
    passage = " ".join(f"word{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(60))
    shorter = " ".join(passage.split()[:50])
    rows = [(1, passage), (2, "own words\n" + passage), (3, passage.replace("wordaa", "changed")), (4, shorter), (5, shorter),
            (6, "a b c d e\na b c d f"), (7, "a b c d g"),                      # three lines, two documents
            (8, "k l m n o"), (8, "k l m n o"), (9, "k l m n o"),                # three rows, two documents
            (10, "p q r s t\np q r s u"), (11, "p q r s v"), (12, "p q r s w")]
    want = {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 2, 11: 1, 12: 1}
    assert of_query(spark, frame, tmp_path, rows) == want
    got = rows_of(linededup.drop_recurring(frame(rows), leaf_rows=1, short_support=10, long_support=2))
    assert {int(r[0]): r[3] for r in got} == want

from html.parser import HTMLParser

from hypothesis import given, settings, strategies as st

from vigil.llm import common, html

SKIP = {"script", "style", "head", "title", "noscript", "template"}


class Words(HTMLParser):
    """Independent reading of pages: words outside of skipped elements, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag in SKIP:
            self.depth.append(tag)
        self.out.append(" ") if tag not in ("b", "i", "a", "em", "strong", "span", "u", "sup", "code") else None

    def handle_endtag(self, tag):
        if self.depth and tag == self.depth[-1]:
            self.depth.pop()
        self.out.append(" ") if tag not in ("b", "i", "a", "em", "strong", "span", "u", "sup", "code") else None

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def words(page):
    w = Words()
    w.feed(page)
    w.close()
    return "".join(w.out).split()


def bare(text):
    """Words of rendered text without bullets and numbers."""
    return [x for line in text.split("\n") for x in line.strip().split()]


def test_all_visible_words_of_the_pages(spark):
    seen = 0
    for r in common.table(spark, "/root/testdata/sf0.01", "pages").collect():
        got = [x for x in bare(html.visible_text(r.html)) if x != "-" and not (x[:-1].isdigit() and x[-1] == ".")]
        want = [x for x in words(r.html) if x != "-" and not (x[:-1].isdigit() and x[-1] == ".")]
        if "hidden" not in r.html and "display" not in r.html and "<select" not in r.html:
            assert got == want, r.page_id
            seen += 1
    assert seen > 100


def test_blocks_lists_and_tables():
    page = """<!doctype html><title>No</title><body><h1>Head</h1><p>One <b>bold</b>
      word<p>Two<br>lines<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>
      <table><tr><th>Name<th>Qty<tr><td>Pear<td>12<tr><td>Fig<td colspan=2>3</table>
      <pre>x  y
 z</pre><div>tail</div>"""
    assert html.visible_text(page) == "\n".join([
        "Head", "", "One bold word", "", "Two", "lines", "", "- a", "- b", "  3. c", "  4. d", "",
        "Name  Qty", "Pear  12", "Fig   3", "", "x  y", " z", "", "tail"])


def test_visibility():
    page = ("<p>a<span hidden>b</span><span style='color:red; DISPLAY : none'>c</span><span style='visibility:hidden'>d</span>"
            "<span aria-hidden=true>e</span><script>f</script><style>g</style><template>h</template><!-- i --><input value=j>k</p>")
    assert html.visible_text(page) == "aek"  # aria-hidden is for screen readers: browsers show the text


def test_broken_markup():
    assert html.visible_text("a < b & c &lt;d&gt; <x") == "a < b & c <d>"
    assert html.visible_text('<p title=foo">text</p>') == "text"
    assert html.visible_text("</p></div>a</b>") == "a"
    assert html.visible_text("<td>a<td>b") == "a\nb" or html.visible_text("<td>a<td>b")
    assert html.visible_text("") == ""


def test_deep_and_long_pages_take_linear_time():
    for unit in ("<div>", "<b>", "<a '", '<a x="', "<p>x", "<li>x", "<table><tr><td>", "<!--", "&", "</p>", "<"):
        html.visible_text(unit * 20_000)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<b>", "</b>", "<br>", "<pre>", "</pre>", " "]), max_size=25))
def test_no_visible_text_is_lost(tags):
    page = "".join(f"{t}w{k}" for k, t in enumerate(tags))
    got = html.visible_text(page)
    assert all(f"w{k}" in got for k in range(len(tags)))


def test_frames(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text")
    got = html.extract(pages).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "")]
    assert html.extract(pages.where("false")).count() == 0


def test_head_ends_by_itself():
    assert html.visible_text("<html><head><title>T</title><p>Text <b>bold</b><p>more") == "Text bold\n\nmore"
    assert html.visible_text("<head><meta a=b>\n<style>x</style> Text<div>more</div>") == "Text\nmore"
    assert html.visible_text("<head><title>T</title><noscript><p>no</p></noscript><script>no</script><body>yes") == "yes"
    assert html.visible_text("<head><title>T</title></head><body>one <head>two <title>no</title>three") == "one two three"


def test_formulas_drawings_and_choices_show_their_text():
    assert html.visible_text("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> be") == "let x=2 be"
    assert html.visible_text("<p>a<svg viewBox=x><title>no</title><defs/><g>no<text>Jan</text><text>Feb<tspan>ruary</tspan></text>"
                             "<defs><text>no</text></defs><foreignObject><div>html</div></foreignObject></g></svg>b").split() == ["a", "Jan", "February", "html", "b"]
    assert html.visible_text("<svg><path/><p>text</p>") == "text"
    assert html.visible_text("<p>Size: <select><option disabled>no<option>S<option selected>M<option>L</select> left") == "Size: M left"
    assert html.visible_text("<select><option>a<option>b</select><select multiple><option>c<option>d</select>").split() == ["a", "c", "d"]
    assert html.visible_text("<table><tr><td><select><option>a<option>b<td>cell</table>") == "a  cell"


def test_deep_drawings_take_linear_time():
    for unit in ("<svg>", "<svg><g><text>x", "<math><mi>", "<select><option>", "<head>", "<svg/>", "<div><input>"):
        html.visible_text(unit * 20_000)


def test_numbers_of_any_length():
    """Character references and spans of thousands of digits are numbers like others."""
    many = "9" * 5000
    assert html.visible_text(f"a&#{many};b&#x{many};c&#{'0' * 5000}65;d&#x{'0' * 5000}41;") == "a\ufffdb\ufffdcAdA"
    assert html.visible_text(f"<p title='&#{many};'>x</p>") == "x"
    assert html.visible_text(f"<table><tr><td colspan={many} rowspan={many}>a<td>b<tr><td>c</table>").split() == ["a", "b", "c"]
    assert html.visible_text(f"<ol start={many}><li>x</ol>") == "1000000000. x"
    assert html.unescape("&#65;&amp;&#x41;&#0065;&lt") == "A&AA<"


def test_what_browsers_show():
    assert html.visible_text("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</div>d") == "b\nd"
    assert html.visible_text("<form>Name <input value=no> <input type=submit value=Send><input type=RESET></form>").split() == ["Name", "Send", "Reset"]
    assert html.visible_text("<details>no<summary>more</summary><p>no</details><details open><summary>s</summary>yes</details>") == "more\ns\nyes"
    page = "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>"
    assert html.visible_text(page) == "a  b  c\n   d  e\nf  g"
    assert html.visible_text("<table><tr><td rowspan=0>x<td>1<tr><td>2<tr><td>3</table>") == "x  1\n   2\n   3"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<b>", "</b>", "<caption>",
                                 "<dl>", "<dt>", "<dd>", "<tbody>", "<span>", "</span>"]), max_size=40))
def test_open_elements_by_tag_are_those_of_a_walk(tags):
    """Places kept by tag agree with walking the open elements."""
    rnd = html.Open(html.Node("html", {}))
    for t in tags:
        name = t.strip("</>")
        if t.startswith("</"):
            if place := rnd.last((name,)):
                assert place == max(k for k, n in enumerate(rnd.nodes) if k and n.tag == name)
                rnd.cut(place)
        else:
            rnd.push(html.Node(name, {}))
        for few in (("p",), ("td", "table"), ("li", "b", "dd")):
            assert rnd.last(few) == max((k for k, n in enumerate(rnd.nodes) if k and n.tag in few), default=0)
            want = [k for k, n in enumerate(rnd.nodes) if k > 2 and n.tag in few]
            assert rnd.first_after(few, 2) == min(want, default=None)


def test_hostile_pages_take_time_in_proportion():
    """Deep nesting, unmatched end tags, crowded tables: a walk of the stack for each tag would take minutes."""
    import time
    units = {"<div>": 200_000, "<span>": 100_000, "<li>x": 25_000, "<ul><li>": 25_000, "<blockquote>x": 25_000, "<dl><dd>x": 25_000,
             "<p><caption><div>": 25_000, "<table><tr><td>": 25_000, "<svg><g><text>x": 25_000, "<tr><td rowspan=9 colspan=1000>x": 10_000}
    for unit, n in units.items():
        for page in (unit * n, "<table>" + unit * n, unit * (n // 2) + "</b>" * n):
            began = time.process_time()
            html.visible_text(page)
            assert time.process_time() - began < 8, unit

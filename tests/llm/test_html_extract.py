from creditloom.llm.html_extract import extract, render
from creditloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def text(page):
    return render(page)[0]


def test_implied_tags():
    assert text("<p>one<p>two<div>three") == "one\n\ntwo\n\nthree"
    assert text("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>") == "- a\n- b\n  3. x\n  4. y\n- c"
    assert text("<dl><dt>t<dd>d<dt>u<dd>e</dl>") == "t\n  d\nu\n  e"
    assert text("a<table><td>x<td>y</table>b") == "a\n\nx | y\n\nb"


def test_visibility():
    page = "<head><title>t</title><style>.gone, #x {display:none} p{color:red}</style></head><p>a<span hidden>b</span><span class='big gone'>c</span>"
    page += "<div id=x>d</div><div style='visibility:hidden'>e<b style='visibility:visible'>f</b></div><script>var g='</p>';</script><!-- h --><template>i</template>j"
    assert text(page) == "a\n\nf\nj"
    assert render(page)[4] >= 5


def test_tables():
    page = "<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td rowspan=2>r<td>1<tr><td>2<tr><td colspan=2>all</table>"
    assert text(page) == "Name  | Qty\nApple | 3\nr     | 1\n      | 2\nall   |"
    assert text(f"<table><tr><td>{'long ' * 20}<td>b<br>c</table>") == ("long " * 20).strip() + "\nb\nc"
    assert text("<table><tr><td><table><tr><td>1<td>2</table><td>x</table>") == "1 | 2 | x"


def test_spaces_and_entities():
    assert text("a &amp; b\n  &lt;c&gt;<br>d<br><br>e <b> f</b>g") == "a & b <c>\nd\ne fg"
    assert text("<pre>  keep\n   this</pre>x") == "  keep\n   this\n\nx".strip("\n")


def test_all_visible_words_of_the_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op9_html_extract"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]
        assert "track(" not in r["text"] and "margin:0" not in r["text"] and "<p>" not in r["text"]
        start = page.index("<article><h1>") + len("<article><h1>")
        head = page[start : page.index("</h1>")]
        if "&" not in head:
            assert " ".join(head.split()) in r["text"]


def test_broken_and_odd_pages(spark):
    broken = ["", None, "<", "<a", "<table><td>x", "</p></div>", "<p" * 500, "<div>" * 20000 + "x", "<!-- unclosed", '<a href="x', "<td>x</td></tr>", "<style>p{}", "<li>" * 500 + "z"]
    for page in broken:
        render(page)
    assert text("<div>" * 20000 + "x") == "x"
    rows = [(i, p, "x") for i, p in enumerate(broken)] + [(None, "<p>a", "y"), (1, None, "z")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert extract(frame).count() == len(rows)
    assert extract(frame.limit(0)).collect() == []


def test_style_sheets_by_media_and_order():
    body = "<div class=nav>menu</div><table><thead><tr><th>h<th>i<tbody><tr><td>1<td>2</table>"
    want = "menu\n\nh | i\n1 | 2"
    assert text(f"<style>@media print{{.nav{{display:none}}}} @media (max-width:600px){{thead{{display:none}}}}</style>{body}") == want
    assert text(f"<style media=print>.nav{{display:none}}</style><style>.nav{{display:none}} .nav{{display:block}}</style>{body}") == want
    assert text(f"<style>/* }} */ .x:after{{content:'}}'}} @import url(a); @font-face{{src:x}} .nav{{display:none}} div{{display:block}}</style>{body}") == want[6:]
    for media in ("@media screen", "@media print, all", "@media not print", "@supports (display:grid)", "@layer base"):
        assert text(f"<style>{media}{{.y{{color:red}} .nav{{display:none}}}}</style>{body}") == want[6:]
    assert text("<style>.a{display:none!important} #b{display:none}</style><p class=a style='display:block'>x<p id=b style='display:block'>y") == "y"


def test_text_of_xmp_math_svg_and_choices():
    assert text("a<xmp>if <b> &amp;\n  c</xmp>d") == "a\n\nif <b> &amp;\n  c\n\nd"
    assert text("x <math><semantics><mrow><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow><annotation>TeX</annotation></semantics></math> y") == "x a=1 2 y"
    assert text("<svg><title>t</title><defs><text>no</text></defs><path d='M0'/><desc/><text>one</text><text>two <tspan>three</tspan></text></svg>z") == "one\ntwo three\nz"
    assert text("of <select><option>one<option selected>two<option>three</select> left") == "of two left"
    assert text("of <select><option disabled>pick<option>one</select> left") == "of one left"
    assert text("<select multiple><optgroup label=g><option>one<option>two</select>") == "g\none\ntwo"
    assert text("<object>plain</object> <object data=a.pdf>b</object><map name=m>c<area></map>") == "plain c"


def test_tables_with_long_cells_keep_rows_and_columns():
    page = f"<table><tr><th>k<th>about<th>n<tr><td>a<td>{'word ' * 14}<td>1<tr><td>b<td>x<br>y<td>2</table>"
    first = " ".join(["word"] * 12)
    rule = f"--+-{'-' * 59}-+--"
    rows = [f"k | {'about'.ljust(59)} | n", f"a | {first} | 1", f"  | {'word word'.ljust(59)} |", f"b | {'x'.ljust(59)} | 2", f"  | {'y'.ljust(59)} |"]
    assert text(page).split("\n") == [rows[0], rule, *rows[1:3], rule, *rows[3:]]
    for n in (60, 61):
        assert text(f"<table><tr><td>{'w' * n}<td>x<tr><td>c<td>y</table>") == f"{'w' * n} | x\n{'c'.ljust(n)} | y"


def test_layout_tables_are_known_by_structure():
    rows = "<tr><td>one<td>two<tr><td>three<td>four"
    assert text(f"<table role=presentation>{rows}</table>") == "one\ntwo\nthree\nfour"
    assert text(f"<table>{rows}<tr><td><article>five</article><td>six</table>") == "one\ntwo\nthree\nfour\nfive\nsix"
    assert text(f"<table>{rows}</table>") == "one   | two\nthree | four"

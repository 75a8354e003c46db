"""Markup: nesting, attributes, letter case, implied ends, character references."""

import html as std
from html.parser import HTMLParser

import pytest

from lendwise.fixtures import table
from lendwise.sources.html import list_links, table_rows

PROBE = """<!DOCTYPE html><!-- <a href="no">no</a> --><script>var s = "<a href='no'>no</a><tr><td>1</td><td>2</td><td>3</td></tr>";</script>
<ul><li><a class='x' href='u'>one <b>bold</b> &amp; more</a></li><li><A title="a > b" data-href="no" HREF = v>  two </A></li></ul>
<TABLE><TR><TH>Name</TH><TH>-</TH><TH>Code</TH></TR>
<tr class="r"><TD>A&amp;B <a>no link</a></TD><td>x</td><td align=left> <b>AB</b> </td></tr>
<tr><td>Cura&#231;ao &#x1F30A;<td>x<td>CW</tr></table>"""


def rows_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")


def test_probe_page(spark):
    df = rows_of(spark, PROBE)
    assert [(r.href, r.text) for r in sorted(list_links(df).collect(), key=lambda r: r.pos)] == [("u", "one bold & more"), ("v", "two")]
    assert sorted((r.code, r["name"]) for r in table_rows(df).collect()) == [("AB", "A&B no link"), ("CW", "Curaçao \U0001f30a")]


@pytest.mark.parametrize(("markup", "links"), [
    ("<a href=x>1<a href='y'>2</a>3", [("x", "1"), ("y", "2")]), ('<a href="open">to the end', [("open", "to the end")]),
    ('<a name="n">anchor</a><a/href="s">t</a>', [("s", "t")]), ("a < b <a href=''>c</a>", [("", "c")]), ("</a><a href=q?a=1&amp;b=2>&lt;x&gt; &amp;lt; &unknown; &#0; &#xD800;</a>", [("q?a=1&b=2", "<x> &lt; &unknown; &#0; &#xD800;")]),
    ("<area href=no><abbr href=no>x</abbr>", []), ("", []), (None, []), ("<a href='x\ny'\n>two\nlines</a>", [("x\ny", "two\nlines")]),
    ("<style>a{}</style><!-- open <a href=no>", []), ("<A\tHREF\n=\n\"z\" >deep <i><b>er</b></i></A >", [("z", "deep er")])])
def test_links(spark, markup, links):
    assert [(r.href, r.text) for r in sorted(list_links(rows_of(spark, markup)).collect(), key=lambda r: r.pos)] == links


@pytest.mark.parametrize(("markup", "cells"), [
    ("<table><tr><td>a<td>b<tr><td>c<td>d</table><tr><td>e</td><td>f", [("a", "b"), ("c", "d"), ("e", "f")]),
    ("<table><tr><td>out<table><tr><td>in1</td><td>in2</td></tr></table></td><td>er</td></tr></table>", [("in1", "in2"), ("out", "er")]),
    ("<td>x</td><td>y</td>", [("x", "y")]), ("<table></table></table><tr></tr>text", []), ("<tr><th>h</th><td>a</td><th>h</th><td>b</td></tr>", [("a", "b")])])
def test_rows(spark, markup, cells):
    got = table_rows(rows_of(spark, markup), code_cell=1, name_cell=0).collect()
    assert [(r["name"], r.code) for r in sorted(got, key=lambda r: r.row)] == cells


class Links(HTMLParser):
    """The same by Python's own parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.open = [], None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.handle_endtag("a")
            self.open = [dict(reversed(attrs)).get("href"), ""]

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            if self.open[0] is not None:
                self.out.append((self.open[0].strip(), self.open[1].strip()))
            self.open = None

    def handle_data(self, data):
        if self.open:
            self.open[1] += data


def test_pages_as_another_parser_reads_them(spark, sf):
    pages = table(spark, sf, "pages")
    got = {}
    for r in sorted(list_links(pages).collect(), key=lambda r: (r.page_id, r.pos)):
        got.setdefault(r.page_id, []).append((r.href, r.text))
    for p in pages.collect():
        parser = Links()
        parser.feed(p.html)
        assert got.get(p.page_id, []) == parser.out
    assert std.unescape("&eacute;&euro;&hellip;") == "é€…"  # the fixed values agree with the standard's

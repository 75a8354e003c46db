"""Reference data from stored web pages (S10), as a Spark job.

The reference scraped a code -> name table from a live page with a browser.
Here pages are rows of a table (``pages.html``) and are read as markup: a page is split into a
token array (tags and text; comments, scripts and styles go first), and a state machine, a
fold over the tokens, builds links and table rows. So nesting, letter case,
attributes in any order and quoting, implied end tags and character references are
handled, and a ``>`` inside an attribute value ends nothing. All of it is
built-in array functions: pages are read in parallel, without Python or a browser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The character references that have a name here; others stay as they are.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "hellip": "…",
         "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "eacute": "é", "euro": "€"}
HIDDEN = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)"
TOKEN = r"""(?s)</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^>"'])*>|<[!?][^>]*>|[^<]+|<"""
ATTRIBUTE = r"""(?s)([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?"""
REFERENCE = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-zA-Z]+;|[^&]+|&"
EDGES = r"^[\s ]+|[\s ]+$"


def _text(s: str) -> str:
    """A SQL text literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def decoded(text: str) -> str:
    """SQL text: character references replaced, once (``&amp;lt;`` is ``&lt;``), and white space cut off at the ends."""
    code = "if(lower(substr(r, 3, 1)) = 'x', CAST(conv(substr(r, 4, length(r) - 4), 16, 10) AS INT), CAST(substr(r, 3, length(r) - 3) AS INT))"
    valid = f"({code}) BETWEEN 1 AND 1114111 AND NOT ({code}) BETWEEN 55296 AND 57343"
    named = "element_at(map(" + ", ".join(f"{_text(k)}, {_text(v)}" for k, v in NAMED.items()) + "), substr(r, 2, length(r) - 2))"
    one = (f"CASE WHEN r LIKE '&#%;' THEN if({valid}, decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32'), r) "
           f"WHEN r LIKE '&_%;' THEN coalesce({named}, r) ELSE r END")
    whole = f"array_join(transform(regexp_extract_all({text}, {_text(REFERENCE)}, 0), r -> {one}), '')"
    return f"regexp_replace(if(contains({text}, '&'), {whole}, {text}), {_text(EDGES)}, '')"


def tokens(html: str, tags: tuple[str, ...]) -> str:
    """SQL text: array of (tag, close, href, text), of the text and the named tags; other tags vanish."""
    name = r"lower(regexp_extract(t, '^</?([a-zA-Z][^\\s/>]*)', 1))"
    rest = r"regexp_replace(t, '^<[a-zA-Z][^\\s/>]*|/?>$', '')"
    names, values = (f"regexp_extract_all({rest}, {_text(ATTRIBUTE)}, {k})" for k in (1, 2))
    at = f"array_position(transform({names}, a -> lower(a)), 'href')"
    value = f"transform(array(element_at({values}, CAST({at} AS INT))), v -> if(v RLIKE '(?s)^([\"\\']).*\\\\1$', substr(v, 2, length(v) - 2), v))[0]"
    href = f"if(t RLIKE '^<[aA][\\\\s/]' AND {at} > 0, {value}, NULL)"
    tag = (f"if(t RLIKE '^</?[a-zA-Z]', named_struct('tag', {name}, 'close', t LIKE '</%', 'href', {href}, 'text', ''), "
           "named_struct('tag', if(t RLIKE '^<[!?]', '!', ''), 'close', false, 'href', CAST(NULL AS STRING), 'text', t))")
    wanted = ", ".join(f"'{x}'" for x in ("", *tags))
    return f"filter(transform(regexp_extract_all(regexp_replace({html}, {_text(HIDDEN)}, ''), {_text(TOKEN)}, 0), t -> {tag}), e -> e.tag IN ({wanted}))"


LINKS = "array<struct<href:string,text:string>>"


def links_of(html: str) -> Column:
    """Array of (href, text): every ``<a>`` with a href, to its end tag or the next ``<a>``."""
    state = lambda href, text, out: f"named_struct('href', {href}, 'text', {text}, 'out', {out})"
    done = "if(s.href IS NULL, s.out, concat(s.out, array(named_struct('href', s.href, 'text', s.text))))"
    step = (f"CASE WHEN e.tag = 'a' AND NOT e.close THEN {state('e.href', quoted(''), done)} WHEN e.tag = 'a' THEN {state('CAST(NULL AS STRING)', quoted(''), done)} "
            f"WHEN s.href IS NOT NULL THEN {state('s.href', 's.text || e.text', 's.out')} ELSE s END")
    start = state("CAST(NULL AS STRING)", quoted(""), f"CAST(array() AS {LINKS})")
    found = f"aggregate({tokens(html, ('a',))}, {start}, (s, e) -> {step}, s -> {done})"
    return F.expr(f"transform({found}, l -> named_struct('href', {decoded('l.href')}, 'text', {decoded('l.text')}))")


def quoted(s: str) -> str:
    return f"'{s}'"


def rows_of(html: str) -> Column:
    """Array of rows, each an array of its ``<td>`` cells. A stack holds the open row of every table around
    the token, so a table inside a cell has rows of its own and adds nothing to the cell."""
    cells = "CAST(array() AS ARRAY<STRING>)"
    row = lambda c, cell: f"named_struct('cells', {c}, 'cell', {cell})"
    none = row("CAST(NULL AS ARRAY<STRING>)", "CAST(NULL AS STRING)")
    state = lambda stack, out: f"named_struct('stack', {stack}, 'out', {out})"
    top, below = "element_at(s.stack, -1)", "slice(s.stack, 1, size(s.stack) - 1)"
    put = lambda r: f"concat({below}, array({r}))"
    closed = f"if({top}.cell IS NULL, coalesce({top}.cells, {cells}), concat(coalesce({top}.cells, {cells}), array({top}.cell)))"
    out = f"if({top}.cells IS NULL AND {top}.cell IS NULL, s.out, concat(s.out, array({closed})))"
    step = " ".join([
        "CASE",
        f"WHEN e.tag = 'table' AND NOT e.close THEN {state(f'concat(s.stack, array({none}))', 's.out')}",
        f"WHEN e.tag = 'table' THEN {state(f'if(size(s.stack) > 1, {below}, array({none}))', out)}",
        f"WHEN e.tag = 'tr' AND NOT e.close THEN {state(put(row(cells, 'CAST(NULL AS STRING)')), out)}",
        f"WHEN e.tag = 'tr' THEN {state(put(none), out)}",
        f"WHEN e.tag = 'td' AND NOT e.close THEN {state(put(row(closed, quoted(''))), 's.out')}",
        f"WHEN e.tag IN ('td', 'th') THEN {state(put(row(closed, 'CAST(NULL AS STRING)')), 's.out')}",
        f"WHEN e.tag = '' AND {top}.cell IS NOT NULL THEN {state(put(row(f'{top}.cells', f'{top}.cell || e.text')), 's.out')}",
        "ELSE s END"])
    start = state(f"array({none})", "CAST(array() AS ARRAY<ARRAY<STRING>>)")
    found = f"aggregate({tokens(html, ('table', 'tr', 'td', 'th'))}, {start}, (s, e) -> {step}, s -> {out})"
    return F.expr(f"transform({found}, r -> transform(r, c -> {decoded('c')}))")


def list_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, href, text) of every link of a page, in order."""
    return pages.select(key, F.posexplode(links_of(f"`{html}`")).alias("pos", "l")).select(key, "pos", "l.href", "l.text")


def table_rows(pages: DataFrame, key: str = "page_id", html: str = "html",
               code_cell: int = 2, name_cell: int = 0) -> DataFrame:
    """(key, row, code, name) from table rows with at least
    ``max(code_cell, name_cell) + 1`` ``<td>`` cells; rows are numbered in the order in which they end."""
    rows = pages.select(key, F.posexplode(rows_of(f"`{html}`")).alias("row", "cells"))
    need = max(code_cell, name_cell) + 1
    return rows.where(F.size("cells") >= need).select(key, "row", F.col("cells")[code_cell].alias("code"), F.col("cells")[name_cell].alias("name"))

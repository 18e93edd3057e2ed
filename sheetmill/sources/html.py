"""Links and headings from raw HTML pages, as row-local Column expressions.

A page is one row, and everything about it is JVM expressions: no explode, no shuffle, no Python.

1. One regular expression cuts the page into tokens: comments, script and style elements with
   their content, declarations, tags (quoted attribute values may hold ``>``), text.
2. ``aggregate`` walks the tokens as a state machine with the stack of open elements, as a
   tree-building parser does: an end tag closes the innermost open element of its name and
   whatever is open inside it, and is ignored if there is none; void and self-closed elements
   hold nothing; elements left open end with the page.
3. An element's text is all text inside it, entities decoded; text in comments, scripts and
   styles is none.

Links resolve against the page's URL by RFC 3986, with dot segments removed by a stack.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"

# Possessive quantifiers throughout: a token is matched in one pass without backtracking.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)"""
_ATTRIBUTE = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE}?+)?+"
_INSIDE = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<(script|style)(?=[\s/>]){_INSIDE}>.*?(?=</\1[\s/>]|\z)"
    rf"|</?[a-z][^\s/>]*+{_INSIDE}>"
    r"|<[!?/][^>]*+>?+"
    r"|(?:[^<]|<(?![a-z/!?]))++"
    r"|<"
)
_HREF = rf"""(?is)^<[^\s/>]++(?:[\s/]++|(?!href[\s=/>]){_ATTRIBUTE})*+href(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+"""
#: Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Named character references that are decoded, beside all numeric ones.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "\u00a9", "reg": "\u00ae", "trade": "\u2122",
    "pound": "\u00a3", "euro": "\u20ac", "cent": "\u00a2", "yen": "\u00a5", "sect": "\u00a7", "deg": "\u00b0", "middot": "\u00b7", "bull": "\u2022",
    "ndash": "\u2013", "mdash": "\u2014", "lsquo": "\u2018", "rsquo": "\u2019", "ldquo": "\u201c", "rdquo": "\u201d", "hellip": "\u2026",
    "laquo": "\u00ab", "raquo": "\u00bb", "times": "\u00d7", "frac12": "\u00bd", "eacute": "\u00e9", "egrave": "\u00e8", "agrave": "\u00e0", "ccedil": "\u00e7",
    "auml": "\u00e4", "ouml": "\u00f6", "uuml": "\u00fc", "szlig": "\u00df", "ntilde": "\u00f1",
}

_TEXT, _START, _END, _ALONE, _SKIP = range(5)
_ELEMENT = "struct<at:int,tag:string,href:string,text:string,stripped:string>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: used as a plain column it would be evaluated
    wherever the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode_entities(c: Column) -> Column:
    """Character references decoded once (``&amp;lt;`` becomes ``&lt;``); unknown names stay."""
    named = F.create_map(*[F.lit(x) for kv in ENTITIES.items() for x in kv])

    def one(t: Column) -> Column:
        number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(t, r"^&#([0-9]{1,7});", 1), F.lit("")), F.lit("9999999")).cast("int"), F.conv(F.nullif(F.regexp_extract(t, r"^&#[xX]([0-9a-fA-F]{1,6});", 1), F.lit("")), 16, 10).cast("int"))
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        known = F.try_element_at(named, F.regexp_extract(t, "^&([A-Za-z0-9]+);", 1))
        return F.when(~F.startswith(t, F.lit("&")), t).when(valid, char).otherwise(F.coalesce(known, t))

    pieces = F.regexp_extract_all(c, F.lit(r"&#?[A-Za-z0-9]+;|[^&]+|&"), F.lit(0))
    return F.when(c.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(c)


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _tokens(html: Column, tags: Sequence[str], with_href: bool) -> Column:
    """array<struct<kind, name, wanted, href, text>> of a page."""

    listed = list(tags)

    def token(t: Column, mark: Column, name: Column) -> Column:
        """``mark``: a, / or ! after the angle bracket of a tag, an end tag or anything else; empty
        for text."""
        opening = mark == "a"
        wanted = opening & name.isin(listed) & (t.rlike(_HREF) if with_href else F.lit(True))
        kind = (
            F.when(mark == "", _TEXT)
            .when(mark == "/", _END)
            .when((mark == "!") | name.isin("script", "style"), _SKIP)
            .when(name.isin(list(VOID)) | F.endswith(t, F.lit("/>")), _ALONE)
            .otherwise(_START)
        )
        href = decode_entities(F.concat(*[F.regexp_extract(t, _HREF, i) for i in (1, 2, 3)])) if with_href else F.lit("")
        text = F.when(mark == "", decode_entities(t)).otherwise("")
        return F.struct(kind.cast("int").alias("kind"), name.alias("name"), wanted.alias("wanted"), F.when(wanted, href).otherwise("").alias("href"), text.alias("text"))

    def one(t: Column) -> Column:
        second, third = F.lower(F.substring(t, 2, 1)), F.lower(F.substring(t, 3, 1))
        letter = lambda c: c.between("a", "z")
        mark = F.when(~F.startswith(t, F.lit("<")), "").when(letter(second), "a").when((second == "/") & letter(third), "/").when(second.isin("!", "?", "/"), "!").otherwise("")
        return _let(mark, lambda m: _let(F.when(m.isin("a", "/"), F.lower(F.regexp_extract(t, r"^</?([A-Za-z][^\s/>]*)", 1))).otherwise(""), lambda name: token(t, m, name)))

    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), one)


def elements(html: Column | str, tags: Sequence[str], with_href: bool = False) -> Column:
    """array<struct<at, tag, href, text, stripped>> of every element with one of ``tags`` (and, if
    asked for, an href), in document order.  ``text`` is all text inside; ``stripped`` joins the
    pieces of text between tags, each without outer white space."""
    no_elements = F.array().cast(f"array<{_ELEMENT}>")

    def with_state(open_: Column, done: Column, n: Column) -> Column:
        return F.struct(open_.alias("open"), done.alias("done"), n.alias("n"))

    def element(at: Column, t: Column) -> Column:
        return F.struct(at.alias("at"), t["name"].alias("tag"), t["href"].alias("href"), F.lit("").alias("text"), F.lit("").alias("stripped"))

    def grown(o: Column, text: Column) -> Column:
        more = F.struct(o["at"].alias("at"), o["tag"].alias("tag"), o["href"].alias("href"), F.concat(o["text"], text).alias("text"), F.concat(o["stripped"], _stripped(text)).alias("stripped"))
        return F.when(o["at"] >= 0, more).otherwise(o)

    def closing(s: Column, t: Column, above: Column) -> Column:
        """State after an end tag; ``above``: how many elements it closes (0: none of its name)."""
        left = F.size(s["open"]) - above
        closed = F.filter(F.slice(s["open"], left + 1, above), lambda o: o["at"] >= 0)
        return F.when(above == 0, s).otherwise(with_state(F.slice(s["open"], F.lit(1), left), F.concat(s["done"], closed), s["n"]))

    def step(s: Column, t: Column) -> Column:
        open_, done, n = s["open"], s["done"], s["n"]
        above = F.array_position(F.reverse(F.transform(open_, lambda o: o["tag"])), t["name"]).cast("int")  # 1: the innermost
        pushed = F.concat(open_, F.array(element(F.when(t["wanted"], n).otherwise(-1), t)))
        return (
            F.when(t["kind"] == _TEXT, F.when(F.exists(open_, lambda o: o["at"] >= 0), with_state(F.transform(open_, lambda o: grown(o, t["text"])), done, n)).otherwise(s))
            .when(t["kind"] == _START, with_state(pushed, done, n + F.when(t["wanted"], 1).otherwise(0)))
            .when(t["kind"] == _END, _let(above, lambda x: closing(s, t, x)))
            .when((t["kind"] == _ALONE) & t["wanted"], with_state(open_, F.concat(done, F.array(element(n, t))), n + 1))
            .otherwise(s)
        )

    end = lambda s: F.array_sort(F.concat(s["done"], F.filter(s["open"], lambda o: o["at"] >= 0)))
    return F.aggregate(_tokens(_col(html), tags, with_href), with_state(no_elements, no_elements, F.lit(0)), step, end)


def anchors(html: Column | str) -> Column:
    """array<struct<href, text>> of every <a> with an href, in document order."""
    return F.transform(elements(html, ("a",), with_href=True), lambda e: F.struct(e["href"].alias("href"), e["text"].alias("text")))


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 5.2.4 for a path that begins with a slash: ``.`` and ``..`` segments are taken
    out, ``..`` with the segment before it; above the root they vanish."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    pop = lambda s: F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda s, x: F.when(x == ".", s).when(x == "..", pop(s)).otherwise(F.concat(s, F.array(x))))
    folder = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), folder)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of ``href`` relative to ``base`` (scheme, network-path, absolute-path, query,
    fragment and relative-path references); dot segments are removed, and empty segments of a
    merged path."""
    return _let(F.struct(_col(base).alias("b"), F.trim(_col(href)).alias("h")), lambda x: _resolved(x["b"], x["h"]))


def _resolved(b: Column, h: Column) -> Column:
    no_frag = F.regexp_replace(b, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    origin = F.regexp_extract(b, _ORIGIN, 1)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    path = F.regexp_extract(h, "^[^?#]*", 0)
    rest = F.substr(h, F.length(path) + 1)
    folder = F.regexp_replace(F.regexp_replace(no_query, _ORIGIN, ""), r"[^/]*$", "")
    merged = F.regexp_replace(F.concat(F.lit("/"), folder, path), "/{2,}", "/")
    tidy = lambda p: _let(p, remove_dot_segments)
    return (
        F.when(h.rlike(_SCHEME), h)
        .when(F.startswith(h, F.lit("//")), F.concat(scheme, F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")), F.concat(origin, tidy(path), rest))
        .when(F.startswith(h, F.lit("#")), F.concat(no_frag, h))
        .when(F.startswith(h, F.lit("?")), F.concat(no_query, h))
        .when(h == "", no_frag)
        .otherwise(F.concat(origin, tidy(merged), rest))
    )


def first_link_containing(html: Column | str, page_url: Column | str, link_text: str, strict: bool = False) -> Column:
    """A6 absolute URL of the first anchor whose text contains ``link_text``."""
    hit = F.try_element_at(F.filter(elements(html, ("a",), with_href=True), lambda a: a["text"].contains(link_text)), F.lit(1))
    out = _let(hit["href"], lambda href: F.when(href.isNotNull(), resolve_url(page_url, href)))
    if strict:
        out = F.coalesce(out, F.raise_error(F.concat(F.lit(f"could not find link '{link_text}' at "), _col(page_url))).cast("string"))
    return out


def heading_texts(html: Column | str, tags: Sequence[str] = ("h2", "h3")) -> Column:
    """Stripped text of every heading with one of ``tags``, in document order.  Text
    pieces are stripped where they meet a tag and joined without a separator."""
    return F.transform(elements(html, tags), lambda e: e["stripped"])


def first_heading_match(html: Column | str, pattern: str, tags: Sequence[str] = ("h2", "h3"), strict: bool = False) -> Column:
    """A7 whole match of ``pattern`` in the first heading (of ``tags``) where it matches."""
    hit = F.try_element_at(F.filter(heading_texts(html, tags), lambda t: t.rlike(pattern)), F.lit(1))
    out = _let(hit, lambda t: F.when(t.isNotNull(), F.regexp_extract(t, pattern, 0)))
    if strict:
        out = F.coalesce(out, F.raise_error(F.lit(f"no heading matches '{pattern}'")).cast("string"))
    return out

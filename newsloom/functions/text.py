"""Text, URL and category expressions, all of them JVM side."""

from __future__ import annotations

import html
import json
import string
from collections.abc import Callable, Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.constants import (
    BLANK,
    BLANK_CHARACTERS,
    CATEGORIES,
    CATEGORY_TYPOS,
    DASHES,
    DEFAULT_CATEGORY,
    QUOTES,
    SENTINELS,
    THAI,
)

# Java tries a character class with many members one member at a time. The
# patterns below therefore look at one cheap class first and check the long one
# behind the character only where the cheap class lets it through.
_ONE_BY_ONE = string.ascii_letters + string.digits
_CONTROL = r"[^ -~](?<=[\r\n\t\x{200B}\x{A0}])[\r\n\t\x{200B}\x{A0}]*"
_QUOTE = r"[^\x{00}-\x{7F}](?<=[" + QUOTES + "])"
_DASH = r"[^\x{00}-\x{7F}](?<=[" + DASHES + "])"
_NOT_KEPT = (
    "[^" + _ONE_BY_ONE + r".,!?%:;()'\-_/" + r"\t\n\x0B\f\r \x1C\x1D\x1E\x1F\x{85}\x{A0}]"
    "(?<![" + THAI + r"\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}])"
)
_BLANK_RUN = f"[^!-~](?=[^!-~])(?<=[{BLANK}])[{BLANK}]+"
_NOT_FEATURE = f"(?:[^{_ONE_BY_ONE} ](?<![{THAI}]))+"


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), 0)


def strip(c: Column) -> Column:
    """Trim every kind of Unicode blank from both ends."""
    return F.btrim(c, F.lit(BLANK_CHARACTERS))


def null_if_in(c: Column, values: Sequence[str] = SENTINELS) -> Column:
    """Null for a text equal to one of ``values``; everything else unchanged."""
    return let(c, lambda x: F.when(~x.isin(*values), x))


def replace_whole(c: Column, mapping: Mapping) -> Column:
    """Replace whole values by ``mapping``; values without an entry stay."""
    out = None
    for old, new in mapping.items():
        out = F.when(c == F.lit(old), F.lit(new)) if out is None else out.when(c == F.lit(old), F.lit(new))
    return c if out is None else out.otherwise(c)


def replace_in(c: Column, targets: Sequence[str], value=None) -> Column:
    """Replace any whole value found in ``targets`` by one scalar value."""
    if isinstance(value, (list, tuple, set)):
        raise ValueError("the replacement must be a single value")
    return F.when(c.isin(*targets), F.lit(value)).otherwise(c)


# Names come from the standard library's table. Names that may stand without their semicolon are few and short.
_NAMED = {name: value for name, value in html5.items() if name.endswith(";")}
_BARE = {name: value for name, value in html5.items() if not name.endswith(";")}
_BARE_LENGTHS = sorted({len(name) for name in _BARE}, reverse=True)
_NAME = r"^[^\t\n\f <&#;]{1,32};?"
_NUMBER = r"^#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?"
# what low numbers stand for is not always the character of that number
_LOW = {str(n): html.unescape(f"&#{n};") for n in range(160) if html.unescape(f"&#{n};") != chr(n)}
_NO_CHARACTER = "\N{REPLACEMENT CHARACTER}"


def _table(values: Mapping[str, str]) -> Column:
    """A constant map from first letter to the values of the names with it, so that a lookup goes through few names."""
    nested: dict[str, dict[str, str]] = {}
    for name, value in values.items():
        nested.setdefault(name[0], {})[name] = value
    return F.from_json(F.lit(json.dumps(nested)), T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))


def _character(n: Column) -> Column:
    """The text of one code point, by its bytes in UTF-8."""
    def tail(shift: int) -> Column:
        return F.shiftright(n, shift).bitwiseAND(F.lit(0x3F)) + 0x80

    two = (F.shiftright(n, 6) + 0xC0) * 256 + tail(0)
    three = ((F.shiftright(n, 12) + 0xE0) * 256 + tail(6)) * 256 + tail(0)
    four = (((F.shiftright(n, 18) + 0xF0) * 256 + tail(12)) * 256 + tail(6)) * 256 + tail(0)
    code = F.when(n < 0x80, F.lpad(F.hex(n), 2, "0")).when(n < 0x800, F.hex(two)).when(n < 0x10000, F.hex(three)).otherwise(F.hex(four))
    return F.decode(F.unhex(code), "UTF-8")


def _numbered(piece: Column) -> Column:
    """The piece behind an ``&`` that begins with a number."""
    decimal, hexadecimal = F.regexp_extract(piece, _NUMBER, 1), F.regexp_extract(piece, _NUMBER, 2)
    digits = F.ltrim(F.when(decimal != "", decimal).otherwise(hexadecimal), F.lit("0"))
    base = F.when(decimal != "", F.lit(10)).otherwise(F.lit(16))
    # the base is a constant of ``conv``, so both are there
    value = F.when(F.length(digits) > 8, F.lit(0x110000).cast("long")).when(base == 16, F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("long")).otherwise(
        F.conv(F.concat(F.lit("0"), digits), 10, 10).cast("long"))
    rest = F.substring(piece, F.length(F.regexp_extract(piece, _NUMBER, 0)) + 1, F.length(piece))
    low = F.from_json(F.lit(json.dumps(_LOW)), T.MapType(T.StringType(), T.StringType()))

    def text(n: Column) -> Column:
        nothing = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        return F.when(n < 160, F.coalesce(F.try_element_at(low, n.cast("string")), _character(n))).when(
            n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit(_NO_CHARACTER)).when(nothing, F.lit("")).otherwise(_character(n))

    return F.concat(let(value, text), rest)


def _named(piece: Column) -> Column:
    """The piece behind an ``&`` that may begin with a name: the whole run up to the semicolon, else its longest bare beginning."""
    named, bare = _table(_NAMED), _table(_BARE)

    def look(table: Column, name: Column) -> Column:
        return F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)

    def decode(run: Column) -> Column:
        rest = F.substring(piece, F.length(run) + 1, F.length(piece))
        found = [F.when(run.endswith(";"), look(named, run)).otherwise(look(bare, run))]
        for size in _BARE_LENGTHS:
            start = F.substring(run, 1, size)
            known = start.isin(*[name for name in _BARE if len(name) == size])
            found.append(F.when((F.length(run) > size) & known, F.concat(look(bare, start), F.substring(run, size + 1, F.length(run)))))
        return F.concat(F.coalesce(*found, F.concat(F.lit("&"), run)), rest)

    return let(F.regexp_extract(piece, _NAME, 0), decode)


def decode_entities(c: Column) -> Column:
    """Decode HTML entities as a browser does: by name, with or without a semicolon, and by number."""
    pieces = F.split(c, "&", -1)
    decoded = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: F.when(p.rlike(_NUMBER), _numbered(p)).otherwise(_named(p)))
    return F.when(c.contains("&"), F.concat(F.get(pieces, 0), F.array_join(decoded, ""))).otherwise(c)


def normalize_text(c: Column, *, entities: bool = True) -> Column:
    """Aggressive cleaner: tags, entities, symbols and stray characters go.

    Symbols without a meaning of their own need no step: they are outside the
    kept characters. Sentinels pass through the cleaning unchanged, so they are
    tested once, at the end. ``entities=False`` is for columns known to hold no
    HTML entities.
    """
    s = decode_entities(c) if entities else c
    s = F.regexp_replace(s, "<[^>]+>", " ")
    s = F.regexp_replace(s, _CONTROL, " ")
    s = F.regexp_replace(s, "&[a-z]+;", " ")
    s = F.regexp_replace(s, _QUOTE, "'")
    s = F.regexp_replace(s, _DASH, "-")
    s = F.regexp_replace(s, _NOT_KEPT, " ")
    s = F.regexp_replace(s, _BLANK_RUN, " ")
    return null_if_in(strip(s))


def clean_keep_meaning(c: Column) -> Column:
    """Light cleaner: control characters, tags, links and truncation marks go,
    repeated punctuation collapses and blanks around punctuation are repaired."""
    s = F.regexp_replace(c, r"[^ -~](?<=[\x{00}-\x{1F}\x{7F}\x{200B}])[\x{00}-\x{1F}\x{7F}\x{200B}]*", " ")
    s = F.regexp_replace(s, "<[^>]+>", " ")
    s = F.regexp_replace(s, r"(?=[hw])(?:http|www)\S+", " ")
    s = F.regexp_replace(s, r"\[\+\d+\s*chars\]", " ")
    s = F.regexp_replace(s, r"([!?.,])\1+", "$1")
    s = F.regexp_replace(s, " {2,}", " ")  # the first step left no other blanks
    s = F.regexp_replace(s, " +([.,!?;:])", "$1")
    s = F.regexp_replace(s, r"([.,!?;:])(?=\S)", "$1 ")
    return let(F.trim(s), lambda x: F.when(x != "", x))


def feature_text(c: Column) -> Column:
    """Lower-case text of ASCII letters, digits, Thai and single blanks; null
    becomes the empty text."""
    s = F.coalesce(c, F.lit(""))
    s = F.regexp_replace(s, f"http[^{BLANK}]+", " ")
    s = F.regexp_replace(s, "<[^\\n]*?>", " ")
    s = F.regexp_replace(s, _NOT_FEATURE, " ")
    s = F.regexp_replace(s, " {2,}", " ")
    return F.lower(F.trim(s))


def normalize_url(c: Column) -> Column:
    """Trimmed URL if it starts with http in any case, else null."""
    return let(strip(c), lambda s: F.when(F.lower(s).startswith("http"), s))


def root_domain(c: Column) -> Column:
    """Second-last label of the authority (the only label if there is one)."""
    authority = F.regexp_extract(c, r"^[\x{00}-\x{20}]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)

    def label(a: Column) -> Column:
        labels = F.split(F.replace(a, F.lit("www."), F.lit("")), r"\.")
        picked = let(labels, lambda parts: F.get(parts, F.greatest(F.size(parts) - 2, F.lit(0))))
        return F.when(a.contains("[") == a.contains("]"), picked)

    return let(let(authority, label), lambda x: F.when(x != "", x))


def first_category(c: Column) -> Column:
    """Lower-case, trimmed, typo-corrected and cut at the first comma.

    The typo table holds whole values and applies before the cut.
    """
    fixed = let(strip(F.lower(c)), lambda x: replace_whole(x, CATEGORY_TYPOS))
    return F.split_part(fixed, F.lit(","), F.lit(1))


def allowed_or_default(c: Column, allowed: Sequence[str] = CATEGORIES, default: str = DEFAULT_CATEGORY) -> Column:
    """Value if allowed, else the default; null also becomes the default."""
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def category_code(c: Column) -> Column:
    """Position of a category in the fixed list; null when not in the list."""
    codes = F.array_position(F.array(*[F.lit(x) for x in CATEGORIES]), c)
    return F.when(codes > 0, (codes - 1).cast("int"))


def category_name(code: Column) -> Column:
    """Category at a position of the fixed list; null when out of range."""
    names = F.array(*[F.lit(x) for x in CATEGORIES])
    return F.when((code >= 0) & (code < len(CATEGORIES)), F.get(names, code.cast("int")))


def canonical_category_list(c: Column) -> Column:
    """``'a', 'b'`` written as ``a,b``."""
    return strip(F.replace(F.replace(c, F.lit("'"), F.lit("")), F.lit(", "), F.lit(",")))


def words(c: Column) -> Column:
    """Lower-case word runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def map_values(c: Column, mapping: Mapping, out_type: str = "string") -> Column:
    """Mapped value, or the value itself where the mapping has none."""
    return replace_whole(c.cast(out_type), {str(k) if out_type == "string" else k: v for k, v in mapping.items()})


def parse_vector(c: Column) -> Column:
    """JSON list text as an array of floats."""
    return F.from_json(c, "array<float>")

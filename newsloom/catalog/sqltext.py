"""The text rules written as SQL, for checking."""

from __future__ import annotations

from newsloom.constants import (
    BLANK, CATEGORIES, CATEGORY_TYPOS, DASHES, DEFAULT_CATEGORY, QUOTES, SENTINELS, SYMBOL_NOISE, THAI,
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(lit(v) for v in values)


def rr(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(by)}, 'g')"


def strip(x: str) -> str:
    return rr(x, f"^[{BLANK}]+|[{BLANK}]+$", "")


def null_if_in(x: str) -> str:
    return f"(case when {x} in ({in_list(SENTINELS)}) then null else {x} end)"


def chain(x: str, *steps) -> str:
    for step in steps:
        x = step(x)
    return x


# entities the given tables hold, also valid without their semicolon; the
# ampersand comes last, as one decoding pass is made
ENTITIES = [("&middot;?", "·"), ("&copy;?", "©"), ("&quot;?", '"'), ("&amp;?", "&")]


def decode(x: str) -> str:
    for name, char in ENTITIES:
        x = rr(x, name, char)
    return x


def normalize_text(x: str, entities: bool = False) -> str:
    """``x`` must be a plain column name, as it is repeated."""
    x = null_if_in(strip(x))
    if entities:
        x = decode(x)
    return null_if_in(chain(
        x,
        lambda s: rr(s, "<[^>]+>", " "),
        lambda s: rr(s, r"[\r\n\t\x{200B}\x{A0}]+", " "),
        lambda s: rr(s, "&[a-z]+;", " "),
        lambda s: rr(s, f"[{SYMBOL_NOISE}]+", " "),
        lambda s: rr(s, f"[{QUOTES}]", "'"),
        lambda s: rr(s, f"[{DASHES}]", "-"),
        lambda s: rr(s, f"[^A-Za-z0-9{THAI}{BLANK}.,!?%:;()'\\-_/]", " "),
        lambda s: rr(s, f"[{BLANK}]{{2,}}", " "),
        strip,
    ))


def clean_keep_meaning(x: str) -> str:
    x = chain(
        x,
        lambda s: rr(s, r"[\x{00}-\x{1F}\x{7F}\x{200B}]+", " "),
        lambda s: rr(s, "<[^>]+>", " "),
        lambda s: rr(s, r"http\S+|www\S+", " "),
        lambda s: rr(s, r"\[\+\d+\s*chars\]", " "),
        # no back-references here: one pattern per repeated character
        lambda s: rr(s, "!{2,}", "!"), lambda s: rr(s, r"\?{2,}", "?"),
        lambda s: rr(s, r"\.{2,}", "."), lambda s: rr(s, ",{2,}", ","),
        lambda s: rr(s, r"\s+", " "),
        lambda s: rr(s, r"\s+([.,!?;:])", r"\1"),
        # no look-ahead here: the next character is taken too, so two passes
        lambda s: rr(s, r"([.,!?;:])(\S)", r"\1 \2"), lambda s: rr(s, r"([.,!?;:])(\S)", r"\1 \2"),
        lambda s: f"trim({s}, ' ')",
    )
    return f"nullif({x}, '')"


def feature_text(x: str) -> str:
    return chain(
        f"coalesce({x}, '')",
        lambda s: rr(s, f"http[^{BLANK}]+", " "),
        lambda s: rr(s, r"<[^\n]*?>", " "),
        lambda s: rr(s, f"[^0-9a-zA-Z{THAI} ]+", " "),
        lambda s: rr(s, " +", " "),
        lambda s: f"lower(trim({s}, ' '))",
    )


def normalize_url(x: str) -> str:
    s = null_if_in(strip(x))
    return f"(case when starts_with(lower({s}), 'http') then {s} end)"


def root_domain(x: str) -> str:
    pattern = lit(r"^[\x{00}-\x{20}]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)")
    labels = f"string_split(replace(regexp_extract({x}, {pattern}, 1), 'www.', ''), '.')"
    return f"nullif(case when len({labels}) >= 2 then {labels}[-2] else {labels}[1] end, '')"


def first_category(x: str) -> str:
    fixed = strip(f"lower({x})")
    cases = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in CATEGORY_TYPOS.items())
    return f"split_part(case {fixed} {cases} else {fixed} end, ',', 1)"


def allowed_or_default(x: str) -> str:
    return f"(case when {x} in ({in_list(CATEGORIES)}) then {x} else {lit(DEFAULT_CATEGORY)} end)"


def category_code(x: str) -> str:
    return f"cast(list_position([{in_list(CATEGORIES)}], {x}) - 1 as integer)"


def published(x: str) -> str:
    """The two timestamp shapes of the adapter, as microseconds."""
    return (
        f"epoch_us(case when {x} like '%Z' then strptime({x}, '%Y-%m-%dT%H:%M:%SZ') "
        f"else strptime({x}, '%Y-%m-%d %H:%M:%S') - interval 7 hour end)"
    )


WORDS = r"[\p{L}\p{N}_]{2,}"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {lit(WORDS)})"

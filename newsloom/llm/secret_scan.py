"""Secrets in texts: keyed assignments, access keys, hex runs, and spans of high entropy.

Only DataFrame operations. Kinds with a pattern are matched leftmost and
without overlap. For places, a text is cut at the matches: gaps and matches
alternate, so their running lengths are the starts. On top, candidate strings
are read through a sliding window: counts of the window's characters are kept
in an array, one is added and one taken away at each step, and with them the
sum of c*log2(c) that the Shannon entropy needs. Each character class has its
own window and threshold; windows above it are merged to spans. Strings of the
allow list are left out.

Defined cases: a null text is an empty one; empty texts have no spans; a null
id is carried; repeated rows give repeated results; other columns are carried
along, except clashing ones named like an output, which are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: patterns and least lengths of the contract
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"  # 18 or more in all; a shorter run has no longer one inside
HEX = "[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]


@dataclass(frozen=True)
class EntropyClass:
    """Characters of a class, the window's length and the entropy in bits a window must reach."""

    kind: str
    alphabet: str
    window: int
    threshold: float


HEX_CLASS = EntropyClass("entropy_hex", "0123456789abcdef", 16, 3.0)
BASE64_CLASS = EntropyClass(
    "entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 20, 3.9)
#: Strings that look random and are no secrets: uuids, digests named as such, repeated or counted-up placeholders, paths.
ALLOW = [
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", r"(?i)^(md5|sha1|sha256|sha512)[-_=].*",
    r"(?i)example|placeholder|changeme|lorem", r"0123456789|1234567890|(?i)abcdefghij", r"(.)\1{7}", r"^(/[a-z0-9_.-]+){2,}$",
]
#: A candidate has a digit, or a capital after a small letter: plain words are not read further.
_ANY = "[A-Za-z0-9+/=_-]"
CANDIDATE = f"(?<!{_ANY})(?={_ANY}{{16}})(?={_ANY}*?(?:[0-9]|[a-z][A-Z])){_ANY}++"


def _matches(text: Column, pattern: str, kind: str, group2: bool = False) -> Column:
    """Array of (start, kind number, end, match, value) of all leftmost matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if group2 else found
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.greatest(F.size(found), F.lit(0))).alias("gap"), found.alias("match"), value.alias("value"))
    spans = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<struct<start:int,kind:int,end:int,match:string,value:string>>").alias("out")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + F.length(p["gap"])).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                (a["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("end"), p["match"].alias("match"),
                p["value"].alias("value")))).alias("out")),
        lambda a: a["out"])
    none = F.lit([]).cast("array<struct<start:int,kind:int,end:int,match:string,value:string>>")
    return F.when(F.size(found) > 0, spans).otherwise(none)


def _c_log_c(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def high_windows(string: Column, of: EntropyClass) -> Column:
    """Array of (start, end), 0-based places in ``string``, of merged windows at or above the threshold.

    The state holds a count for each character of the class, the sum of c*log2(c),
    and the length of the run of class characters read so far. A character
    outside the class empties the window.
    """
    zeros = F.lit([0] * len(of.alphabet))
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(of.alphabet), c))
    start = F.struct(
        zeros.alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("run"), F.lit(0).alias("at"),
        F.lit([]).cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(codes_array: Column):
        def one(a: Column, code: Column) -> Column:
            full = a["run"] >= of.window
            gone = F.when(full & (code > 0), F.get(codes_array, a["at"] - of.window)).otherwise(F.lit(0))
            has_in = F.coalesce(F.get(a["counts"], code - 1), F.lit(0)) - F.when(gone == code, 1).otherwise(0)
            has_out = F.coalesce(F.get(a["counts"], gone - 1), F.lit(0))
            taken = F.when(gone > 0, _c_log_c(has_out - 1) - _c_log_c(has_out)).otherwise(F.lit(0.0))
            total = a["sum"] + taken + _c_log_c(has_in + 1) - _c_log_c(has_in)
            counts = F.transform(a["counts"], lambda c, j: c + F.when(j == code - 1, 1).otherwise(0) - F.when(j == gone - 1, 1).otherwise(0))
            run = F.when(code > 0, a["run"] + 1).otherwise(F.lit(0))
            bits = F.log2(F.lit(float(of.window))) - total / F.lit(float(of.window))
            high = (code > 0) & (run >= of.window) & (bits >= of.threshold - 1e-9)
            end = a["at"] + 1
            last = F.get(a["spans"], F.size(a["spans"]) - 1)
            here = F.struct((end - of.window).alias("start"), end.alias("end"))
            joined = F.concat(F.slice(a["spans"], 1, F.greatest(F.size(a["spans"]) - 1, F.lit(0))),
                              F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
            spans = F.when(~high, a["spans"]).when(
                (F.size(a["spans"]) > 0) & (last["end"] >= end - of.window), joined).otherwise(F.concat(a["spans"], F.array(here)))
            return F.struct(
                F.when(code > 0, counts).otherwise(zeros).alias("counts"), F.when(code > 0, total).otherwise(0.0).alias("sum"),
                run.alias("run"), end.alias("at"), spans.alias("spans"))

        return one

    # bound once, as the step looks back into it
    return F.get(F.transform(F.array(codes), lambda cs: F.aggregate(cs, start, step(cs), lambda a: a["spans"])), F.lit(0))


def _entropy_spans(candidates: Column, of: EntropyClass, allow: list[str]) -> Column:
    allowed = F.lit(False)
    none = F.lit([]).cast("array<struct<start:int,end:int>>")

    def spans(c: Column) -> Column:
        held = allowed
        for pattern in allow:
            held = held | c["match"].rlike(pattern)
        found = F.when(held | (F.length(c["match"]) < of.window), none).otherwise(high_windows(c["match"], of))
        return F.transform(found, lambda w: F.struct(
            (c["start"] + w["start"]).alias("start"), F.lit(KINDS.index(of.kind)).alias("kind"), (c["start"] + w["end"]).alias("end")))

    return F.flatten(F.transform(candidates, spans))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, *, text_col: str = "text", classes: tuple[EntropyClass, ...] = (HEX_CLASS, BASE64_CLASS),
                 allow: list[str] | None = None) -> DataFrame:
    """``docs`` with ``base_spans`` and ``secret_spans``: sorted arrays of (start, kind number, end)."""
    allow = ALLOW if allow is None else allow
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = F.lit(False)
    for word in ASSIGN_WORDS:
        names = names | F.contains(F.lower(text), F.lit(word))
    none = F.lit([]).cast("array<struct<start:int,kind:int,end:int,match:string,value:string>>")
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    held = docs.drop("base_spans", "secret_spans").withColumns({
        "__assign": F.when(names, F.filter(_matches(text, ASSIGN, "assign", True), lambda m: F.length(m["value"]) >= ASSIGN_LEAST)).otherwise(none),
        "__access": F.when(F.contains(text, F.lit("AKIA")), _matches(text, ACCESS, "access")).otherwise(none),
        "__hex": _matches(text, HEX, "hex"),
        "__candidates": _matches(text, CANDIDATE, "entropy_base64"),
    })
    based = held.withColumn("base_spans", F.array_sort(F.concat(plain(F.col("__assign")), plain(F.col("__access")), plain(F.col("__hex")))))
    more = F.concat(F.col("base_spans"), *[_entropy_spans(F.col("__candidates"), c, allow) for c in classes])
    return based.withColumn("secret_spans", F.array_sort(more)).drop("__assign", "__access", "__hex", "__candidates")


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the pattern spans and all spans as text."""
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return scanned.select(
        id_col, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"))

import html
import html.entities
import random
import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.constants import CATEGORIES, DASHES, QUOTES, SENTINELS
from newsloom.functions import text as X
from newsloom.functions.times import normalize_timestamp
from newsloom.plans.gold import gold_category


def test_sentinels(column):
    values = [*SENTINELS, None, "x", "n/a", " none"]
    assert column(X.null_if_in, values) == [None] * len(SENTINELS) + [None, "x", "n/a", " none"]


def test_root_domain(column):
    values = ["https://www.bbc.co.uk/x", "http://m.tionsh.example.net/en", "http://localhost:80/a", "foo/bar",
              "https://u:p@a.b.com:443/", "", None, "//h.example.org", "http://[::1/x", "http://www.www.a.b/"]
    assert column(X.root_domain, values) == [
        "co", "example", "localhost:80", None, "b", None, None, "example", None, "a"]


def test_url(column):
    values = [" HTTPS://a ", "ftp://a", "N/A", None, "httpfoo", " http://x\x1c"]
    assert column(X.normalize_url, values) == ["HTTPS://a", None, None, None, "httpfoo", "http://x"]


def test_clean_keep_meaning(column):
    values = ["Hi!!!", "you ,me", "a.,b..c", "", None, "x​y\x01z", "see https://a.b/c now", "cut [+3880 chars]",
              "<b>bold</b>", "wait...what?? yes"]
    assert column(X.clean_keep_meaning, values) == [
        "Hi!", "you, me", "a. , b. c", None, None, "x y z", "see now", "cut", "bold", "wait. what? yes"]


def test_feature_text(column):
    values = ["Hello, World! <i>x</i> http://a.b/c กขค é", None, "  ", "a<b\nc>d"]
    assert column(X.feature_text, values) == ["hello world x กขค", "", "", "a b c d"]


def test_normalize_text_literals(column):
    values = ["  N/A ", "Tom &amp; Jerry", "<p>a</p>&nbsp;&nbsp;b", "café", "“q” — • x", "a\r\n\tb", None,
              "&lt;b&gt;t", "&bogus; x", "-", "กขค 123", "　"]
    assert column(X.normalize_text, values) == [
        None, "Tom Jerry", "a b", "caf", "'q' - x", "a b", None, "t", "x", None, "กขค 123", None]


def rules_in_python(s):
    """The cleaning rules said once more, with Python's regular expressions."""
    s = html.unescape(s.strip())
    s = re.sub("<[^>]+>", " ", s)
    s = re.sub("[\r\n\t​\xa0]+", " ", s)
    s = re.sub("&[a-z]+;", " ", s)
    s = re.sub(f"[{QUOTES}]", "'", s)
    s = re.sub(f"[{re.sub(r'.x.(....).', lambda m: chr(int(m[1], 16)), DASHES)}]", "-", s)
    s = re.sub(r"[^A-Za-z0-9ก-๙\s.,!?%:;()'\-_/]", " ", s)
    s = re.sub(r"\s{2,}", " ", s).strip()
    return None if s in SENTINELS else s


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.one_of(
    st.characters(blacklist_categories=("Cs",), max_codepoint=0x3100),
    st.sampled_from(list("<>&; \t\x1c\x85\xa0 ​“”–—•é\U0001f600'abcกข"))), max_size=40), min_size=20, max_size=60))
def test_normalize_text_equals_the_rules(column, texts):
    texts = [t.replace("\x00", "") for t in texts]
    assert column(X.normalize_text, texts) == [rules_in_python(t) for t in texts]


def test_entities_only_where_there_are_some(column):
    assert column(X.decode_entities, ["&#8217;x", "plain", None, "&copy", "&amp;lt;"]) == ["’x", "plain", None, "©", "&lt;"]


def test_timestamps(column):
    cases = {
        "2025-10-06T06:00:00Z": datetime(2025, 10, 6, 6), "2025-10-06 06:00:00": datetime(2025, 10, 5, 23),
        "garbage": None, "undefined": None, None: None, "": None, "06:00": None, "2025": None,
        "2025-10-06 06:00": datetime(2025, 10, 5, 23), "2025-10-06": datetime(2025, 10, 5, 17),
        "2025-10-06 06:00:00 +0000": datetime(2025, 10, 6, 6), "2025-10-06T06:00:00.5+09:00": datetime(2025, 10, 5, 21, 0, 0, 500000),
        "Mon, 06 Oct 2025 06:00:00 GMT": datetime(2025, 10, 6, 6), "10/06/2025 06:00": datetime(2025, 10, 5, 23),
        "2025-13-45 00:00:00": None, "2025-10-06 25:00:00": None, " 2025-10-06T06:00:00Z ": datetime(2025, 10, 6, 6),
    }
    assert column(normalize_timestamp, list(cases)) == list(cases.values())
    assert column(lambda c: normalize_timestamp(c, "-0330"), ["2025-10-06 06:00:00"]) == [datetime(2025, 10, 6, 9, 30)]


def test_categories(column):
    first = column(X.first_category, [" Politic ", "poltics,x", "technology,science", "weather", None])
    assert first == ["politics", "poltics", "technology", "weather", None]
    assert column(X.allowed_or_default, first) == ["politics", "general", "technology", "general", "general"]
    codes = column(X.category_code, [*CATEGORIES, "weather", None])
    assert codes == [0, 1, 2, 3, 4, 5, 6, 7, None, None]
    assert column(X.category_name, [0, 7, 8, -1, None], "int") == ["business", "politics", None, None, None]


@pytest.mark.parametrize("max_bytes", [1000, 0])
def test_gold_category_counts_raw_values(spark, max_bytes):
    rows = [" Politic "] * 5 + ["politics"] * 4 + ["technology,science"] * 5 + ["weather"] * 9 + [None] * 6
    df = spark.createDataFrame([(i, c) for i, c in enumerate(rows)], "id int, category string")
    got = {r["id"]: r["category"] for r in gold_category(df, max_bytes=max_bytes).collect()}
    assert [got[i] for i in range(len(rows))] == (
        ["politics"] * 5 + ["general"] * 4 + ["technology"] * 5 + ["general"] * 15)


def test_replacements(column):
    assert column(lambda c: X.replace_whole(c, {"a": "b", "b": "c"}), ["a", "b", "ab", None]) == ["b", "c", "ab", None]
    assert column(lambda c: X.replace_in(c, ["", " "]), ["", " ", "x", None]) == [None, None, "x", None]
    with pytest.raises(ValueError):
        X.replace_in(F.col("x"), ["a"], ["b"])
    assert column(X.canonical_category_list, ["'a', 'b'", " x ", None]) == ["a,b", "x", None]
    assert column(X.words, ["Don't do_it, a 42 Été!", None]) == [["don", "do_it", "42", "été"], None]
    assert column(X.parse_vector, ["[1.5, 2]", "[]"]) == [[1.5, 2.0], []]
    assert column(lambda c: X.map_values(c, {"a": "1"}), ["a", "z", None]) == ["1", "z", None]


def test_entities_equal_the_standard_library(column):
    draw = random.Random(5)
    names = list(html.entities.html5)
    texts = [f"a&{n}b" for n in names] + [f"&{n}" for n in names] + [f"&{n[:-1]}x;" for n in names[::7]]
    texts += [f"&#{n};{n}&#x{n:x}" for n in [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 10**25]]
    texts += ["&", "&&amp;", "&#;", "&#x;", "&#xg", "&#0065", "&#X41;", "&#00000000000000000065;", "&notit;", "&notin;", "& amp;", "&amp&lt", "&a" * 40, "&" + "b" * 40 + ";", ""]
    texts += ["".join(draw.choice(["&", "#", "x", ";", "amp", "lt", "not", "1", "38", " ", "\t", "é", "<"]) for _ in range(9)) for _ in range(1500)]
    got = column(X.decode_entities, texts)
    assert [(t, g) for t, g in zip(texts, got) if g != html.unescape(t)] == []

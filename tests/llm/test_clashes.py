from newsloom.llm import kneser_ney, line_dedup, mixing, pieces

WORKING = ["whole", "__whole", "__of", "__cut", "__source", "__spot", "gone", "__gone", "lang_cut", "band_cut", "__lang_cut", "__key", "__nll",
           "cut", "fraction", "key", "nll", "band", "spot", "id", "__missing", "__text", "__doc", "__row", "target", "copies"]


def test_columns_named_like_working_ones(spark):
    rows = [(i, f"some words of text number {i % 7}\nand a second line", "en", f"s{i % 3}", *["own"] * len(WORKING)) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in WORKING)
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    for made in (mixing.mix_sources(docs), kneser_ney.judge_quality(docs, labels), line_dedup.remove_lines(docs), pieces.encode_texts(docs)):
        found = made.collect()
        assert len(found) == 30
        for c in ("gone", "whole", "lang_cut", "band_cut", "cut", "key", "id"):  # those without underscores come through
            assert {r[c] for r in found} == {"own"}

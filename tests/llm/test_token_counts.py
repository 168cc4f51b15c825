import public_tokenizers
import sentencepiece

from lakeloom.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library_also_for_split_texts(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "LONG_BYTES", 40)
    plain = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["", " ", "a", "  lead and trail  ", "x  y   z " * 30, "word\n next\t tab " * 40, "</s><s> [INST] <unk> " * 20, "ünï cödé 漢字 🎉 " * 30, "nospace" * 100, "▁ ▁a b▁ c " * 30, " ".join("abcdefgh"[i % 8] * (i % 13) for i in range(500)), "a b 　 c " * 30]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(99, None, None), (99, None, None), (None, "a b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(df, MODEL, limit=10).collect()]
    want = [(i, len((t or "").encode()), n := len(plain.encode(t or "")), n > 10) for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_vocabulary_splits_and_real_texts_agree(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(token_counts, "LONG_BYTES", 200)
    plain = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert token_counts.load(MODEL)[1]
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, MODEL).collect()}
    assert got == {r["doc_id"]: len(plain.encode(r["text"])) for r in df.collect()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert token_counts.count_tokens(df, MODEL).collect() == []

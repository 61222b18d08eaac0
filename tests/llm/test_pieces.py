import numpy as np
import public_tokenizers
import sentencepiece

from formtide.llm.pieces import SPACE, Encoder, MergeEncoder, Pieces, decode_ids, encode_texts
from tests.llm.cases import awkward_docs, empty_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


def best_score(text, score, longest, unknown):
    """Brute force: highest total over all segmentations."""
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            gain = score.get(text[start:end], unknown if end - start == 1 else -np.inf)
            best[end] = max(best[end], best[start] + gain)
    return best[-1]


def test_highest_score_and_round_trip(spark):
    pieces = Pieces.read(PATH)
    encoder = Encoder(pieces)
    score = dict(zip(pieces.texts, pieces.scores))
    by_id = dict(zip(pieces.ids.tolist(), pieces.scores))
    texts = [r.text or "" for r in awkward_docs(spark).collect()][:80]
    texts += ["Größe 漢字かな 🙂 x́", "  two  spaces ", "tab\tnew\nline", "a" * 50, "<s> </s> <0x41>"]
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text, end, count in zip(texts, ends, counts):
        own = ids[end - count : end].tolist()
        assert model.decode(own) == text  # the library decodes our ids to the text
        ready = SPACE + text.replace(" ", SPACE) if text else ""
        single = sum(c not in score for c in ready)
        got = sum(by_id.get(i, 0.0) for i in own) + single * encoder.unknown
        assert abs(got - best_score(ready, score, encoder.longest, encoder.unknown)) < 1e-6


def test_rows_of_a_table(spark):
    docs = awkward_docs(spark)
    rows = encode_texts(docs, PATH)
    assert rows.filter("restored").count() == docs.count()
    back = decode_ids(rows, PATH)
    plain = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    assert back.exceptAll(plain).count() == 0 and plain.exceptAll(back).count() == 0
    assert encode_texts(empty_docs(spark), PATH).count() == 0


def test_vocabulary_may_be_forgotten():
    pieces = Pieces.read(PATH)
    small, large = Encoder(pieces, most=5), Encoder(pieces)
    for text in ("one two three four five six seven", "six seven eight nine ten eleven", "one two"):
        assert small.encode([text])[0].tolist() == large.encode([text])[0].tolist()


def test_ids_of_a_merge_model_are_those_of_its_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(300)
    texts = [r.text or "" for r in awkward_docs(spark).collect()]
    texts += ["Größe 漢字かな 🙂 x́", "  two  spaces ", "tab\tnew\nline", "a" * 5000, " " * 700, "<s> </s> <0x41>", "Our Elle"]
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.unionByName(extra)
    expected = {r.doc_id: model.encode(r.text or "") for r in docs.collect()}
    got = {r.doc_id: r.ids for r in encode_texts(docs, PATH).collect()}
    assert got == expected


def test_long_and_short_parts_are_cut_alike():
    pieces = Pieces.read(PATH)
    batched, heap = MergeEncoder(pieces), MergeEncoder(pieces, longest_batched=0)
    texts = ["Our tokenization of unbelievable aaaaaaaaaaa", "größte Übung 漢字 🙂🙂", "x" * 100]
    assert batched.encode(texts)[0].tolist() == heap.encode(texts)[0].tolist()

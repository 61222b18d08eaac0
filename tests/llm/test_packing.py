import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from formtide.llm.packing import ChunkEncoder, cut_all, pack_documents, slices
from tests.llm.cases import awkward_docs, empty_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def cut(total, capacity, smallest):
    """Lengths of the pieces of a document, one by one."""
    out, rest, size = [capacity] * (total // capacity), total % capacity, capacity // 2
    while size >= smallest:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


def test_all_documents_are_cut_as_one_by_one():
    totals = np.array([1, 5000, 2048, 64, 63, 2047, 1, 4097, 130])
    rows, starts, lengths = cut_all(totals, 2048, 64)
    for row, total in enumerate(totals):
        own = lengths[rows == row].tolist()
        assert own == cut(int(total), 2048, 64) and starts[rows == row].tolist() == (np.cumsum(own) - own).tolist()


def test_ids_are_those_of_the_tokenizer(spark):
    tokenizer, encoder = Tokenizer.from_file(PATH), ChunkEncoder(PATH)
    texts = [r.text or "" for r in awkward_docs(spark).collect()] + [" lead", "trail ", "a \x1c b", "don't we'll <|endoftext|>"]
    small = ChunkEncoder(PATH, most=3, most_bytes=10)  # begins anew all the time
    assert [small.encode(texts[i : i + 7])[0].tolist() for i in range(0, len(texts), 7)] == [
        encoder.encode(texts[i : i + 7])[0].tolist() for i in range(0, len(texts), 7)
    ]
    ids, sizes = encoder.encode(texts)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    for text in texts:
        parts = list(slices(text, 50))
        assert "".join(parts) == text
        assert encoder.encode(parts)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece_and_sequences_have_no_gap(spark):
    docs = awkward_docs(spark)
    rows = pack_documents(docs, PATH, capacity=256, smallest=16).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = defaultdict(list)
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        start = 0
        for length in cut(len(ids), 256, 16):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            expected[r.doc_id].append((start, length, crc, len(ids)))
            start += length
        assert start == len(ids)
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    used = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
        used += at
    assert used / (256 * len(sequences)) > 0.9


def test_empty_table(spark):
    assert pack_documents(empty_docs(spark), PATH).count() == 0

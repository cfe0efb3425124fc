import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from forumlens.llm import packing
from forumlens.llm.queries import ENTRIES


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def best_fit(lengths, window):
    """Plain best fit decreasing: the fill of every window."""
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= n
        else:
            room.append(window - n)
    return sorted(window - r for r in room)


@pytest.mark.parametrize("seed", range(30))
def test_planned_runs_are_best_fit_decreasing(seed):
    draw = random.Random(seed)
    window = draw.choice([8, 10, 37, 64])
    lengths = [draw.randint(1, window) if draw.random() < 0.7 else draw.choice([1, window, window // 2]) for _ in range(draw.randint(0, 200))]
    runs = packing.plan({n: lengths.count(n) for n in set(lengths)}, window)
    fill, spans = {}, {}
    for rank, n in enumerate(sorted(lengths)):
        first, length, sequence, each, offset = runs[np.searchsorted(runs[:, 0], rank, "right") - 1]
        assert length == n
        at = int(sequence + (rank - first) // each)
        spans.setdefault(at, []).append((int(offset + (rank - first) % each * n), n))
    for at, parts in spans.items():
        position = 0
        for offset, n in sorted(parts):
            assert offset == position
            position += n
        fill[at] = position
        assert position <= window
    assert sorted(fill.values()) == best_fit(lengths, window)
    assert sorted(fill) == list(range(len(fill)))


TEXTS = [
    None, "", " ", "  two  spaces ", "a b", " lead", "trail ", "line\nbreak \n next", "tab\tand odd space", "don't we'll I'M 1234 x²½",
    "é漢字 emoji 🎉🎉", "<|endoftext|> <s>", "\x1f \x1f", "a\x1c b", "word " * 30_000, "x" * 40_000, "end.", "\n", "\n\n a",
]


def test_ids_are_the_tokenizers(tokenizer):
    encode = packing.Encoder(packing.RANKS)
    rng = random.Random(5)
    odd = ["".join(rng.choice("ab é\n\t .'s1 ​🎉") for _ in range(40)) for _ in range(500)]
    for text in [t or "" for t in TEXTS] + odd:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def held(rows, tokenizer, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.WINDOW
    return by_doc, by_sequence


def test_every_id_lies_in_one_piece(documents, tokenizer):
    texts = dict(enumerate(TEXTS))
    by_doc, _ = held(packing.digests(documents(*texts.items())).collect(), tokenizer, texts)
    assert set(by_doc) == set(texts)


def test_repeated_rows_and_null_ids_are_packed_each(documents):
    rows = packing.digests(documents((1, "same text"), (1, "same text"), (None, "no id"), (None, "no id"))).collect()
    assert len(rows) == 4 and sum(r.length for r in rows) == sum(r.doc_tokens for r in rows)
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == 4


def test_sequences_hold_the_ids_and_are_padded(documents, tokenizer):
    texts = {i: f"document number {i} " * (1 + i * 9) for i in range(40)}
    frame = documents(*texts.items())
    for row in packing.sequences(frame).collect():
        ids = np.frombuffer(row.ids, "<u4")
        assert len(ids) == packing.WINDOW
        used = 0
        for p in row.pieces:
            whole = [*tokenizer.encode(texts[p.doc_id], add_special_tokens=False).ids, 0]
            assert ids[p.offset : p.offset + p.length].tolist() == whole[p.start : p.start + p.length]
            used += p.length
        assert not ids[used:].any()


def test_empty_table_and_clashing_columns(written, documents):
    assert packing.digests(documents(files=1).where("doc_id = 0")).count() == 0
    frame = written([(1, "a b", "x", "y")], "doc_id int, text string, start string, length string")
    assert packing.digests(frame).count() == 1


ADDED_TEXTS = ["<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>  b\n", "x<|endoftext|><|endoftext|>y z", "<|endoftext|", "<<|endoftext|>>", " <|endoftext|>"]


@pytest.fixture(scope="module")
def contract():
    """The tokenizer as it is given: its added tokens match inside texts."""
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_added_tokens_are_the_files():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        assert {t["content"]: t["id"] for t in json.load(file)["added_tokens"]} == packing.ADDED


def test_ids_with_added_tokens_are_the_tokenizers(contract):
    encode = packing.Encoder(packing.RANKS, packing.ADDED)
    rng = random.Random(6)
    odd = ["".join(rng.choice(["a", "b ", " ", "\n", "<|endoftext|>", "<", "|", ">", "é", "'s"]) for _ in range(30)) for _ in range(500)]
    for text in [t or "" for t in TEXTS] + ADDED_TEXTS + odd:
        assert np.frombuffer(encode(text), "<u4").tolist() == contract.encode(text, add_special_tokens=False).ids


def test_query_and_pipeline_find_added_tokens(spark, documents, contract, tmp_path):
    texts = dict(enumerate(TEXTS + ADDED_TEXTS))
    frame = documents(*texts.items())
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    by_query = ENTRIES["op7_pack"].run(spark, str(tmp_path)).collect()
    by_stage = corpus_pipeline.pack_sequences(spark, frame, str(tmp_path)).collect()
    for rows in (by_query, by_stage):
        by_doc, _ = held(rows, contract, texts)
        assert set(by_doc) == set(texts)

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorflow.llm import packing, token_files, tokens
from tests.llm.helpers import ODD, documents, prose

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_units_encode_like_whole_texts(path):
    r = random.Random(1)
    parts = ["a", " ", "  ", "\n", "\n\n", "\t", "'s", "don't", "É", "3", "12", "!!", "\x1c", "\xa0", "<|endoftext|>", "word", " the", "Σ", "\x00", "\r\n", "é"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(1500)] + [None, "", " ".join(prose(1, 3000))]
    enc, lib = tokens.UnitEncoder(path, cache_units=200), Tokenizer.from_file(path)
    for _ in range(2):
        ids, off = enc.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_signs_and_letters_are_units_of_their_own():
    r = random.Random(3)
    parts = ["word", "Word", "für", "É", "J\u030c", "j", "\u030c", "H", "\u0331", "ß", "×", "'", "'s", "'S", ",", "(", ")", ".", "_", "7", "½", "Σ", "İ", "…", "漢", " ", " "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    enc, lib = tokens.UnitEncoder(WORD), Tokenizer.from_file(WORD)
    ids, off = enc.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    few = tokens.UnitEncoder(WORD)
    few.encode(["word Word, WORD. (word) für Für, für."])
    assert few.units == 6  # word für , . ( )


def expected(rows, path):
    lib = Tokenizer.from_file(path)
    return [np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows]


def corpus():
    return [(k, " ".join(prose(k, 1 + (k * 37) % 900))) for k in range(60)] + [(500, " ".join(prose(3, 9000)))] + ODD


def test_packing_covers_every_piece_once(spark):
    rows = corpus()
    got = packing.pack(documents(spark, rows), BYTE, with_ids=True).collect()
    want = []
    for (name, _), ids in zip(rows, expected(rows, BYTE)):
        a, z, k = 0, len(ids) % 1024 or 1024, 0
        while a < len(ids):
            want.append((name, k, a, z - a, zlib.crc32(ids[a:z].tobytes()), ids[a:z].tobytes()))
            a, z, k = z, z + 1024, k + 1
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"]))) for r in got)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(seqs) <= -(-total // 1024) * 1.06 + 1


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_plan_uses_the_histogram_up(n):
    r = np.random.default_rng(n)
    hist = np.bincount(np.clip(r.lognormal(5.5, 1, n).astype(int), 1, 1024), minlength=1025)
    used = np.zeros(1025, int)
    planned = packing.plan(hist)
    for p, k in planned:
        assert sum(p) <= 1024 and k > 0
        np.add.at(used, list(p), k)
    assert (used == hist).all()
    total = int(hist @ np.arange(1025))
    assert sum(k for _, k in planned) <= -(-total // 1024) * 1.02 + 1


def test_nnls_fits_an_exact_histogram():
    hist = np.zeros(1025)
    hist[[300, 724]] = 50
    assert packing.nnls_counts([(300, 724), (512, 512)], hist).round().tolist() == [50, 0]


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 20000])
def test_section_round_trip_and_damage(n):
    r = np.random.default_rng(n)
    ids = np.tile((r.zipf(1.4, max(1, n // 2)) % 49408).astype(np.uint32), 3)[:n]
    data = token_files.encode_section(ids, b"meta")
    back, meta = token_files.decode_section(data)
    assert (back == ids).all() and meta == b"meta"
    if n > 2048:
        assert len(data) < 2 * n
        bad = bytearray(data)
        bad[-len(data) // 3] ^= 64
        with pytest.raises((ValueError, zlib.error)):
            token_files.decode_section(bytes(bad))


def test_crc_of_joined_parts():
    x = bytes(range(256)) * 5
    assert token_files.crc32_join([(zlib.crc32(x[a:b]), b - a) for a, b in ((0, 3), (3, 3), (3, 700), (700, 1280))]) == zlib.crc32(x)


def test_token_files_round_trip(spark, tmp_path):
    rows = corpus() + [(7, "repeated id"), (7, "repeated id")]
    docs = documents(spark, rows).repartition(5)
    path = str(tmp_path / "files")
    token_files.write_sections(docs, WORD, path, "doc_id", "text", 2, section=3000, block=512)
    got = token_files.read_documents(spark.read.parquet(path)).collect()
    want = sorted(str((n, len(i), zlib.crc32(i.tobytes()))) for (n, _), i in zip(rows, expected(rows, WORD)))
    assert sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))


def test_empty_tables(spark):
    none = documents(spark, [])
    assert packing.pack(none, BYTE).collect() == []
    assert token_files.token_files(none, WORD).collect() == []

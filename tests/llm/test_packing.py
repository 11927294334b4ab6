import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wayfuse.llm import packing
from wayfuse.llm.common import settings
from tests.llm.frames import clashing, docs


def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(rng):
    bits = ["the", " and", "  ", "\n", " \n", "\n ", "\t", "é", "ü", "don't", "I'll", "123", " 4", "...", " ", " x", " ", "   ", "<|endoftext|>",
            "日本", "🙂", "\r\n", "a_b", "%%%", "'s", "\x0b", "\x1c", "x"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(3000)]


def test_ids_are_the_tokenizers():
    own, made = texts(random.Random(6)), packing._Ids("byte_bpe_50k")
    ids, ends = made.of(own)
    start = 0
    for text, end, want in zip(own, ends.tolist(), whole().encode_batch(own, add_special_tokens=False)):
        assert ids[start:end].tolist() == want.ids, repr(text)
        start = end


def test_pieces_and_places(spark, monkeypatch):
    settings(spark)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["red", "green", "Bluest", "zq"], k=rng.choice([0, 3, 30, 200])))) for i in range(300)]
    rows += [(500, None), (501, ""), (7, rows[7][1]), (None, "last one")]
    frame = clashing(docs(spark, rows))
    got = packing.pack(packing.pieces(frame, 64), 64, group=40, opened=4, fan=3).collect()
    tokenizer, want = whole(), []
    for k, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        want += [(k, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 64
    assert len(bins) <= 1.1 * sum(r.length for r in got) / 64 + 2
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_search_empties_bins():
    lengths = [6, 6, 5, 5, 3, 3, 2, 2, 4, 4]  # 40 in all, best fit by hand-made start of five bins
    start = [[0, 6], [1, 7], [2, 4], [3, 5], [8, 9]]
    done = packing.local_search([list(b) for b in start], lengths, 10)
    assert sorted(i for b in done for i in b) == list(range(10))
    assert all(sum(lengths[i] for i in b) <= 10 for b in done) and len(done) == 4

import hashlib
import random
from collections import Counter

import numpy as np

from tests.llm.frames import SCHEMA, clashing
from wayfuse.llm import alignment
from wayfuse.llm.common import settings


def tokens_by_hand(text):
    """Both vocabularies' (ids, bytes) of a text, straight from the libraries."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    if not hasattr(tokens_by_hand, "a"):
        tokens_by_hand.a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        tokens_by_hand.a.encode_special_tokens = True
        tokens_by_hand.b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a, b = tokens_by_hand.a, tokens_by_hand.b
    assert decoders.ByteLevel
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: others are shifted up
    shifted = {chr(c): c for c in printable} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in printable)}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(shifted[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
               for p in map(b.id_to_piece, ids_b)]
    return ids_a, bytes_a, ids_b, bytes_b


def groups_by_hand(text):
    if not text:
        return []
    ids_a, bytes_a, ids_b, bytes_b = tokens_by_hand(text)
    if b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    both, out, x, y = sorted(set(ends_a) & set(ends_b)), [], 0, 0
    for end in both:
        x2, y2 = ends_a.index(end) + 1, ends_b.index(end) + 1
        out.append((ids_a[x:x2], ids_b[y:y2]))
        x, y = x2, y2
    return out


def by_hand(rows):
    linked = [Counter((a, b) for g in groups_by_hand(t) for a in g[0] for b in g[1]) for _, t in rows]
    counts = Counter(p for own in linked for p in own)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (doc, text), own in zip(rows, linked):
        groups = groups_by_hand(text)
        listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(own.values()),
                    sum(n for p, n in own.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in own.items()),
                    hashlib.sha256(listed.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


TEXTS = ["The quick brown fox.", "  two  spaces ", "tab\tand\nline", "naïve café ½ ﬁ ﷽ 日本語 テスト", "a▁b", "<|endoftext|> <s> <unk> <0x41>",
         "x" * 700, "🙂🙃 emoji", "don't we'll I'm", "", None, " ", "▁", "The quick brown fox.", "\x00 odd \r\n", "0123456789 3.14",
         "antidisestablishmentarianism " * 3, "é   nbsp", "日" * 300]


def test_against_by_hand(spark):
    settings(spark)
    rng = random.Random(3)
    words = [w for t in TEXTS if t for w in t.split(" ")]
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(3, TEXTS[3])]
    frame = spark.createDataFrame([(i, t, "x", "s", 1) for i, t in rows], SCHEMA)
    want = by_hand(rows)
    for table, block in ((frame.repartition(3), 400), (clashing(frame), 1 << 20)):
        got = alignment.align(table, block=block)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_take_part_in_stretches(monkeypatch):
    aligner = alignment.Aligner()
    rng = random.Random(4)
    words = ["unhappiness", "tokenization", "Straße", "x1y2", "of", "naïveté", "日本語"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 900, 1, 5000)] + ["日" * 3000, None, "", "a"]
    whole = aligner.of(texts)
    monkeypatch.setattr(alignment, "LANE", 50)
    monkeypatch.setattr(alignment, "WIDE", 4)
    parts = aligner.of(texts)
    for k in whole:
        assert np.array_equal(whole[k], parts[k]), k
    assert whole["n_groups"].tolist()[5:7] == [0, 0] and whole["groups"][5] == ""


def test_cached_words_equal_whole_texts():
    b = alignment._TokensB(alignment.VOCABULARY_B)
    for text in TEXTS:
        if text:
            assert b.of([text])[0].tolist() == b.model.encode(text)

"""Trie BPE against the tokenizers library and against merging pair by pair."""

import hashlib
import json
import random
import struct
from collections import Counter

import pytest
from tokenizers import Tokenizer

from matchlake.llm import trie_bpe as B


@pytest.fixture(scope="module")
def coder():
    with open(B.default_path(), "rb") as file:
        return B.Coder(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.default_path())


def brute(rows, library):
    out = Counter()
    for d, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        out[d, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False).encode())] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())


def odd_texts(rng, times):
    signs = ["<|endoftext|>", "<|endof", "'s", "'LL", "don't", " ", "  ", "\t", "\n", "\r\n", "\x85", "\xa0", "​", "x", "é", "字", "²", "\x00", "😀", "1"]
    kinds = [
        lambda: "".join(rng.choice("aehinorst") for _ in range(rng.randrange(400))),
        lambda: "".join(chr(c) for c in (rng.randrange(0x110000) for _ in range(80)) if not 0xD800 <= c < 0xE000),
        lambda: "".join(rng.choice(signs) for _ in range(80)),
        lambda: "".join(rng.choice("aa =-") for _ in range(200)),
        lambda: "".join(chr(rng.randrange(32, 127)) for _ in range(200)),
    ]
    return [k() for k in kinds for _ in range(times)]


def test_odd_texts(coder, library):
    texts = odd_texts(random.Random(11), 200)
    for text, ids in zip(texts, coder.encode_block(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(ids).cast("I")) == want
        assert coder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_any_vocabulary():
    """Random merges over a few letters, where ties and runs are common, against merging pair by pair."""
    rng = random.Random(5)
    for _ in range(20):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        while len(vocab) < 40:
            pair = rng.choice(list(vocab)), rng.choice(list(vocab))
            if "".join(pair) not in vocab and len("".join(pair)) <= 9:
                merges.append(list(pair))
                vocab["".join(pair)] = len(vocab)
        rank = {tuple(m): i for i, m in enumerate(merges)}

        def merged(word):
            parts = list(word)
            while True:
                found = min(((rank.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:]))), default=(1 << 30, 0))
                if found[0] == 1 << 30:
                    return [vocab[p] for p in parts]
                i = found[1]
                parts[i:i + 2] = ["".join(parts[i:i + 2])]

        level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        tables = B.Coder(json.dumps({"added_tokens": [], "normalizer": None, "pre_tokenizer": level, "post_processor": None, "decoder": level,
                                     "model": {"type": "BPE", "vocab": vocab, "merges": merges}}).encode())
        if any(merged(t) != [i] for t, i in vocab.items()):
            continue  # an id that no text encodes to
        words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))).encode() for _ in range(100)}
        for word, ids in tables.encode_words(words).items():
            assert list(memoryview(ids).cast("I")) == merged(word.decode())


def test_trie():
    words = sorted({b"", b"a", b"abc", b"abd", b"ab", b"b", b"abcde", b"xyz", b"xy"})
    trie, path, seen, edges = B.Trie(), b"", [], 0
    for i, w in enumerate(words):
        trie.insert(w, i)
    for depth, edge, number in trie.walk():
        path = path[:depth] + edge
        edges += len(edge)
        if number is not None:
            seen.append((path, number))
    assert seen == [(w, i) for i, w in enumerate(words)] and edges == len({w[:n] for w in words for n in range(1, len(w) + 1)})


def test_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(B.report(docs)) == brute(rows, library)


def test_both_directions(frame, odd, library):
    texts = odd_texts(random.Random(2), 5)
    rows = [(100 + i, t, None, None) for i, t in enumerate(texts)] + odd
    docs = frame(rows)
    ids = B.encoded(docs)
    want = Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows)
    assert Counter((r.doc_id, tuple(memoryview(bytes(r.ids)).cast("I"))) for r in ids.collect()) == want
    assert Counter(tuple(r) for r in B.decoded(ids).collect()) == Counter((d, t or "") for d, t, *_ in rows)
    assert got(B.report(docs)) == brute(rows, library)
    assert B.report(frame([])).collect() == B.encoded(frame([])).collect() == []


def test_small_blocks_and_tables(frame, odd, library, monkeypatch, coder):
    """Blocks of a few bytes and tables that start anew all the time change nothing."""
    texts = [t for _, t, *_ in odd if t and len(t) < 1000] + odd_texts(random.Random(3), 4)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for name, value in {"KEPT_WORDS": 3, "KEPT_BYTES": 2, "KEPT_PAIRS": 5}.items():
        monkeypatch.setattr(B, name, value)
    assert [list(memoryview(coder.encode_block([t])[0]).cast("I")) for t in texts] == want


def test_long_words(coder, library):
    for text in ("ab" * 60_000, "9" * 100_000, " " * 50_000 + "x", "=" * 50_000):
        assert list(memoryview(coder.encode_block([text])[0]).cast("I")) == library.encode(text, add_special_tokens=False).ids


def test_other_formats_are_refused():
    with open(B.default_path(), "rb") as file:
        spec = json.load(file)
    spec["normalizer"] = {"type": "Lowercase"}
    with pytest.raises(ValueError):
        B.Coder(json.dumps(spec).encode())

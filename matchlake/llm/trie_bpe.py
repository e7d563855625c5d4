"""Byte-level BPE by a walk over a trie of distinct words.

Texts are split into words by the vocabulary's pattern; in each task the distinct new words of a block
of documents go into a trie, which is walked depth first. The state of a node is the last id of the
encoding of its prefix. That is enough: an encoding without its last id is the encoding of the rest,
and two ids may follow each other exactly if their own bytes encode to the two of them. So the last id
at a node is the one id that ends there and may follow the last id of the prefix before it; there is
always just one. A prefix that many words share is computed once, and a word's ids are read off by
stepping back from its node. The words of a block are kept packed, and repeated ones are looked up.

Whether two ids may follow each other is decided from the merges that built them. From the border
outwards each side is a list of symbols, and each symbol lives until the merge that swallows it. A
merge across the border happens if two symbols that live at the same time have one that comes before
the ends of both; among equal merges the leftmost comes first, so one inside the left id goes before it.

Words are inserted in order; edges are byte strings, so the trie's size grows with the number of words and not with their
lengths, and a word of any length costs time in proportion to its length. Blocks are bounded by bytes,
tables by numbers of entries (they start anew when full, which changes no result).

The tokenizer file is read on the driver and sent to the tasks as it is (about 2 MB); it must be a
byte-level BPE without normaliser, added spaces or dropout. Strings of its added tokens in a text are
those tokens, as the format prescribes. Decoding joins the ids' bytes; broken UTF-8 becomes U+FFFD.

Cases: a null text is empty and has no ids; an empty table gives an empty result; ids and texts of any
length are handled whole; repeated rows stay.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

#: The words of the format's byte-level splitting, and the bytes that it shows as themselves.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Bytes of text whose words are looked up together.
BLOCK = 1 << 22
#: Words kept packed, the longest of them, and pairs of ids kept as decided.
KEPT_WORDS, KEPT_BYTES, KEPT_PAIRS = 1 << 19, 64, 1 << 21
NEVER = 1 << 60


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_signs() -> dict[str, int]:
    """The character that stands for each byte: itself if shown, else the next one from 256 on."""
    hidden = [b for b in range(256) if b not in set(SHOWN)]
    return {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Trie:
    """Words by their bytes, inserted in order. A node is [depth above its edge, edge, its word's number
    or None, children]."""

    def __init__(self):
        self.root = [0, b"", None, []]
        self.path, self.before = [self.root], b""

    def insert(self, word: bytes, number: int) -> None:
        """Add a word that is greater than all before it: its branch leaves the last word's path where
        the two begin to differ."""
        shared = 0
        for x, y in zip(self.before, word):
            if x != y:
                break
            shared += 1
        self.before, path = word, self.path
        while path[-1][0] >= shared and len(path) > 1:
            path.pop()
        top = path[-1]
        if top[0] + len(top[1]) > shared:  # the branch leaves inside this edge
            at = shared - top[0]
            top[3], top[2], top[1] = [[shared, top[1][at:], top[2], top[3]]], None, top[1][:at]
        if shared == len(word):
            top[2] = number  # the empty word
            return
        node = [shared, word[shared:], number, []]
        top[3].append(node)
        path.append(node)

    def walk(self) -> Iterator[tuple[int, bytes, int | None]]:
        """(depth above the edge, edge, number) of all nodes, depth first."""
        todo = [self.root]
        while todo:
            depth, edge, number, children = todo.pop()
            yield depth, edge, number
            todo += reversed(children)


class Coder:
    """The tables of a tokenizer file, and its two directions."""

    def __init__(self, source: bytes):
        spec = json.loads(source)
        model, words, end = spec["model"], spec["pre_tokenizer"] or {}, spec["decoder"] or {}
        plain = model["type"] == "BPE" and words.get("type") == end.get("type") == "ByteLevel" and words.get("use_regex") and not any(
            [spec["normalizer"], words.get("add_prefix_space"), spec["post_processor"], model.get("dropout"), model.get("byte_fallback"),
             model.get("ignore_merges"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix")])
        added = spec["added_tokens"]
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("not a plain byte-level BPE")
        sign = byte_signs()
        self.ids = {bytes(sign[c] for c in token): i for token, i in model["vocab"].items()}
        self.shown = {i: token for token, i in self.ids.items()}
        # an added token's string stands for bytes like any other; one that does not is taken as UTF-8
        known = lambda s: all(c in sign for c in s)
        self.added = {t["content"]: t["id"] for t in added}
        self.shown |= {i: bytes(sign[c] for c in s) if known(s) else s.encode() for s, i in self.added.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        self.words = regex.compile(WORDS)
        self.rank, self.parts = {}, {}
        for at, merge in enumerate(model["merges"]):
            left, right = (self.ids[bytes(sign[c] for c in half)] for half in (merge.split(" ") if isinstance(merge, str) else merge))
            made = self.ids[self.shown[left] + self.shown[right]]
            self.rank[left, right] = at
            self.parts[made] = (left, right, at)
        self.prefixes = {b"": 0}  # beginnings of ids, numbered when met; a state is the longest one that ends here
        self.begins = {token[:n] for token in self.ids for n in range(1, len(token) + 1)}
        self.states, self.moves, self.ends = [b""], {}, [[]]
        self.sides, self.pairs, self.packed = ({}, {}), {}, {}

    def side(self, token: int, right: int) -> list[tuple[int, int]]:
        """(symbol, rank of the merge that ends it) at the id's left or right border, innermost first."""
        found = self.sides[right].get(token)
        if found is None:
            found, end = [], NEVER
            symbol = token
            while True:
                found.append((symbol, end))
                if symbol not in self.parts:
                    break
                end = self.parts[symbol][2]
                symbol = self.parts[symbol][right]
            found.reverse()
            self.sides[right][token] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether the bytes of the ids a and b together encode to a and b."""
        left, right, i, j = self.side(a, 1), self.side(b, 0), 0, 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            across = self.rank.get((x, y), NEVER)
            if across < x_end and across <= y_end:
                return across == NEVER
            if x_end == y_end == NEVER:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def move(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        here = self.states[state] + bytes([byte])
        while here not in self.begins:
            here = here[1:]
        if here not in self.prefixes:
            self.prefixes[here] = len(self.states)
            self.states.append(here)
            found = ((self.ids.get(here[i:]), len(here) - i) for i in range(len(here)))
            self.ends.append([f for f in found if f[0] is not None])  # ids that end here, longest first
        found = self.moves[state << 8 | byte] = self.prefixes[here]
        return found

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The packed ids of distinct words."""
        words, trie, out = sorted(words), Trie(), {}
        for number, word in enumerate(words):
            trie.insert(word, number)
        moves, ends, pairs, shown = self.moves, self.ends, self.pairs, self.shown
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        last, reached = [], [0]  # along the path: the last id of each prefix, and its state
        for depth, edge, number in trie.walk():
            del last[depth:], reached[depth + 1:]
            state = reached[depth]
            for end, byte in enumerate(edge, depth + 1):
                try:
                    state = moves[state << 8 | byte]
                except KeyError:
                    state = self.move(state, byte)
                for token, n in ends[state]:
                    if n == end:
                        break
                    pair = last[end - n - 1] << 32 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.follows(last[end - n - 1], token)
                    if fits:
                        break
                last.append(token)
                reached.append(state)
            if number is not None:
                found, end = [], len(last)
                while end:
                    token = last[end - 1]
                    found.append(token)
                    end -= len(shown[token])
                found.reverse()
                out[words[number]] = struct.pack(f"<{len(found)}I", *found)
        return out

    def split(self, text: str) -> list:
        """The words of a text; an added token is its id."""
        if self.cut is None:
            return self.words.findall(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append(self.added[part])
            else:
                out += self.words.findall(part)
        return out

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        packed = self.packed
        if len(packed) > KEPT_WORDS:
            packed.clear()
        new = set().union(*split).difference(packed)
        made = {w: struct.pack("<I", w) for w in new if isinstance(w, int)}
        as_bytes = {w.encode(): w for w in new if not isinstance(w, int)}
        made |= {as_bytes[raw]: ids for raw, ids in self.encode_words(as_bytes).items()}
        long = [w for w in made if not isinstance(w, int) and len(w) > KEPT_BYTES]
        packed |= made
        out = [b"".join([packed[w] for w in words]) for words in split]
        for w in long:
            del packed[w]
        return out

    def decode(self, ids: bytes) -> str:
        shown = self.shown
        return b"".join([shown[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_CODERS: dict[bytes, Coder] = {}


def coder(source: bytes) -> Coder:
    """The tables of a file, made once in a worker process."""
    key = hashlib.sha256(source).digest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(source)
    return _CODERS[key]


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``BLOCK`` bytes in their last column, or of one row."""
    for batch in batches:
        start = held = 0
        for i in range(batch.num_rows):
            size = len(batch.column(batch.num_columns - 1)[i].as_buffer())
            if held and held + size > BLOCK:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _mapped(docs: DataFrame, doc_id: str, value, path: str | None, columns: dict, work) -> DataFrame:
    """(doc_id, *columns) from ``work(coder, values)`` over blocks of rows."""
    with open(path or default_path(), "rb") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        tables = coder(source.value)
        for block in blocks(batches):
            found = work(tables, [v.as_py() for v in block.column(1)])
            yield pa.RecordBatch.from_arrays([block.column(0), *[pa.array(f, t) for f, t in zip(found, columns.values())]], ["doc_id", *columns])

    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    shape = ", ".join([f"doc_id {docs.schema[doc_id].dataType.simpleString()}", *[f"{c} {kinds[t]}" for c, t in columns.items()]])
    return docs.select(F.col(doc_id).alias("doc_id"), value.alias("value")).mapInArrow(run, shape)


def _texts(values: list[bytes]) -> list[str]:
    return [v.decode("utf-8", "replace") for v in values]


def encoded(docs: DataFrame, doc_id="doc_id", text="text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ``ids``: little-endian unsigned 32-bit integers, packed."""
    def work(tables, values):
        ids = tables.encode_block(_texts(values))
        return [len(i) // 4 for i in ids], ids

    return _mapped(docs, doc_id, whole(text).cast("binary"), path, {"n_tokens": pa.int64(), "ids": pa.binary()}, work)


def decoded(rows: DataFrame, doc_id="doc_id", ids="ids", path: str | None = None) -> DataFrame:
    """doc_id and the ``text`` of packed ids; null ids are an empty text."""
    value = F.coalesce(F.col(ids), F.lit(b""))
    return _mapped(rows, doc_id, value, path, {"text": pa.string()}, lambda tables, values: ([tables.decode(v) for v in values],))


def report(docs: DataFrame, doc_id="doc_id", text="text", path: str | None = None) -> DataFrame:
    """Both directions in one pass: doc_id, n_tokens and the digests of the ids and of the decoded text."""
    def work(tables, values):
        ids = tables.encode_block(_texts(values))
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        return [len(i) // 4 for i in ids], [sha(i) for i in ids], [sha(tables.decode(i).encode()) for i in ids]

    columns = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    return _mapped(docs, doc_id, whole(text).cast("binary"), path, columns, work)

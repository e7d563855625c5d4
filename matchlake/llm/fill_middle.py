"""Fill-in-middle: texts cut at lines and put together again in another order, by a secondary sort.

A text is cut into n lines at two places drawn from a digest of its id. Chunks of whole lines (pieces)
leave the mapper keyed by document and output position; ``repartitionAndSortWithinPartitions`` brings
those of one document into one stream in output order, where a running digest or a writer takes them
piece by piece. To restore, the pieces of the *output* are keyed by their original position, which
follows from the form and the marks alone, and sorted again by the same call; as documents stay in
their partition, that second sort shuffles nothing. No task holds a text whole after it has been cut;
the sorts spill. Partitions have about ``PART_BYTES``; beyond ``MOST_PARTS`` of them they grow instead.

The key of a document is a digest of its id and text and the number of the partition that read it, so
documents are dealt evenly however many share an id, a text or nothing (null). Rows that are equal in
both are one stream whose pieces come several times; the first of each is used and the number of
first pieces says how many rows to give back. The key depends on the data and its reading only, so a
task that runs again sends the same pieces to the same places.

Cases: a null text is empty; a null id is the text "" in the draw; an empty text, or one that holds a
mark, is ``plain`` and stays as it is; a line longer than a piece is several pieces; a last line
without line feed counts as one; very long texts are streamed; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import chain

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole

MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: The order of sections in the output of a form, and in the text.
OUTPUT = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
TEXT = ("prefix", "middle", "suffix")
SALT = 7
#: Per cent of documents that are turned, and of those the per cent in suffix-prefix-middle form.
RATE, SPM_RATE = 100, 50
#: Bytes of whole lines that make up a piece.
CHUNK = 1 << 16
#: Bytes of text that are sorted together, and the most partitions there are.
PART_BYTES, MOST_PARTS = 1 << 25, 1 << 15
#: Bytes of a document's key; the position follows.
KEY = 20


def drawn(doc_id, n: int) -> tuple[int, int, int, int]:
    """(end of the prefix, end of the middle, number for turning, number for the form)."""
    digest = hashlib.sha256(f"{SALT}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    return (*sorted((h[0] % (n + 1), h[1] % (n + 1))), h[2] % 100, h[3] % 100)


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, in bytes; a line feed belongs to its line."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def code_points(text: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def chunks(text: bytes, ends: np.ndarray, low: int, high: int, size: int = CHUNK) -> Iterator[bytes]:
    """The bytes from ``low`` to ``high`` in pieces of whole lines; a longer line is cut."""
    while low < high:
        last = int(np.searchsorted(ends, low + size, "right")) - 1
        end = int(ends[last]) if last >= 0 and ends[last] > low else low + size
        yield text[low:min(end, high)]
        low = min(end, high)


def cut(doc_id, text: bytes, rate: int, spm_rate: int, size: int) -> tuple[tuple, Iterator[bytes]]:
    """((n, form, code points of prefix and of middle), pieces of the output, marks among them)."""
    ends = line_ends(text)
    n = len(ends)
    first, second, turn, form = drawn(doc_id, n)
    if not text or any(m in text for m in MARKS.values()) or turn >= rate:
        return (n, "plain", None, None), chunks(text, ends, 0, len(text), size)
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    form, where = "spm" if form < spm_rate else "psm", {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(text))}

    def pieces():
        for section in OUTPUT[form]:
            mark = MARKS[section]
            for piece in chunks(text, ends, *where[section], size):
                yield mark + piece
                mark = b""
            if mark:
                yield mark

    return (n, form, code_points(text[:a]), code_points(text[a:b])), pieces()


def keyed(key: bytes, position: int) -> bytes:
    return key + position.to_bytes(8, "big")


def emitted(number: int, rows: Iterable, **how: int) -> Iterator[tuple]:
    """Pieces of all rows by key and output position; the first of a document comes with what is told of it."""
    place = number.to_bytes(4, "big")
    for doc_id, text in rows:
        text = bytes(text)
        key = hashlib.blake2b(f"{'-' if doc_id is None else doc_id}:".encode() + text, digest_size=KEY - 4).digest() + place
        told, pieces = cut(doc_id, text, **how)
        yield keyed(key, 0), ((doc_id, *told), next(pieces, b""))
        for position, piece in enumerate(pieces, 1):
            yield keyed(key, position), piece


def dealt(key: bytes) -> int:
    return int.from_bytes(key[:8], "big")


def once_each(pieces: Iterable) -> Iterator[tuple]:
    """(key, value, times) of a sorted stream, with equal keys as one."""
    last, value, times = None, None, 0
    for key, other in pieces:
        if key == last:
            times += 1
            continue
        if times:
            yield last, value, times
        last, value, times = key, other, 1
    if times:
        yield last, value, times


def documents(pieces: Iterable) -> Iterator[tuple]:
    """(key, first value, its times, the later values in order) of each document in a sorted stream;
    the values must be used up before the next document."""
    stream = once_each(pieces)
    held = next(stream, None)
    while held is not None:
        key, first, times = held[0][:KEY], *held[1:]
        held = None

        def later():
            nonlocal held
            for item in stream:
                if item[0][:KEY] != key:
                    held = item
                    return
                yield item[1]

        yield key, first, times, later()


def original(form: str, pieces: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(original position, bytes) of an output's pieces, from 1; the marks say which section begins."""
    section, base = 0, 1 << 40
    for i, piece in enumerate(pieces, 1):
        if form != "plain":
            for name, mark in MARKS.items():
                if piece.startswith(mark):
                    section, piece = TEXT.index(name), piece[len(mark):]
                    break
        if piece:
            yield section * base + i, piece


def sink(whole_texts: bool):
    """(start, add, end) of what becomes of a stream: a joined text, or its digest."""
    if whole_texts:
        return list, list.append, lambda parts: b"".join(parts).decode("utf-8", "replace")
    return hashlib.sha256, lambda digest, piece: digest.update(piece), lambda digest: digest.hexdigest()


def outputs(sorted_pieces: RDD, whole_texts: bool) -> RDD:
    """The pieces again, keyed by their place in the original, before them what is told and the output."""
    start, add, end = sink(whole_texts)

    def fold(stream):
        for key, (told, first), times, later in documents(stream):
            out = start()

            def passed():
                for piece in chain([first], later):
                    add(out, piece)
                    yield piece

            for position, piece in original(told[2], passed()):
                yield keyed(key, position), piece
            yield keyed(key, 0), (told, end(out), times)

    return sorted_pieces.mapPartitions(fold, preservesPartitioning=True)


def restored(sorted_pieces: RDD, whole_texts: bool) -> RDD:
    """Finished rows from the pieces in original order."""
    start, add, end = sink(whole_texts)

    def fold(stream):
        for _, (told, output, times), _, later in documents(stream):
            text = start()
            for piece in later:
                add(text, piece)
            row = (*told, output, end(text))
            for _ in range(times):
                yield row

    return sorted_pieces.mapPartitions(fold)


def _turned(docs: DataFrame, doc_id: str, text: str, names: tuple[str, str], whole_texts: bool, how: dict) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length(whole(text)))).head()[0] or 0
    parts = min(MOST_PARTS, 1 + size // PART_BYTES)
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).cast("binary").alias("text")).rdd
    once = rows.mapPartitionsWithIndex(partial(emitted, **how)).repartitionAndSortWithinPartitions(parts, dealt)
    back = outputs(once, whole_texts).repartitionAndSortWithinPartitions(parts, dealt)
    count = lambda name: T.StructField(name, T.LongType())
    label = lambda name: T.StructField(name, T.StringType())
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), count("n"), label("form"), count("prefix_chars"), count("middle_chars"), *map(label, names)])
    return docs.sparkSession.createDataFrame(restored(back, whole_texts), schema, verifySchema=False)


def transformed(docs: DataFrame, doc_id="doc_id", text="text", rate=RATE, spm_rate=SPM_RATE, size=CHUNK) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, the ``output`` and the text ``restored`` from it."""
    return _turned(docs, doc_id, text, ("output", "restored"), True, {"rate": rate, "spm_rate": spm_rate, "size": size})


def report(docs: DataFrame, doc_id="doc_id", text="text", rate=RATE, spm_rate=SPM_RATE, size=CHUNK) -> DataFrame:
    """As ``transformed``, with running SHA-256 digests in place of the texts."""
    return _turned(docs, doc_id, text, ("output_sha256", "restored_sha256"), False, {"rate": rate, "spm_rate": spm_rate, "size": size})

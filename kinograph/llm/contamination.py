"""Evaluation texts that leak into documents: an FM-index per shard of the corpus.

A task reads documents as sequences of words.  Words that no test item has
cannot be in a match: they cut a document into runs, and only runs of at least
a phrase's length are indexed.  Runs are gathered into shards of
``shard_words`` words; each shard gets an FM-index (suffix order,
Burrows-Wheeler transform, wavelet tree, sampled suffix places), all phrases
of the test items are searched backwards in it at once, and their occurrences
are located and merged into spans per document and item.

Texts are read once, where they lie; nothing but the spans leaves a task.  The
test items go to the tasks in blocks of a bounded number of words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinograph.llm.fmindex import FMIndex

#: Maximal runs of letters and digits: what Python counts as a word character, without the underscore.
_WORD = re.compile(r"[^\W_]+")
_SPANS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("word_from", pa.int64()), ("word_to", pa.int64()), ("char_from", pa.int64()), ("char_to", pa.int64())])
_OTHER = 1


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def char_places(text: str) -> tuple[list[int], list[int]]:
    """Where each word of ``words(text)`` starts and ends in ``text`` itself."""
    low = text.lower()
    spans = [m.span() for m in _WORD.finditer(low)]
    if len(low) != len(text):  # lower case of a few letters is longer than they are
        back = [i for i, ch in enumerate(text) for _ in ch.lower()]
        if len(back) != len(low):
            back = [min(i, len(text) - 1) for i in range(len(low))]
        spans = [(back[a], back[b - 1] + 1) for a, b in spans]
    return [a for a, _ in spans], [b for _, b in spans]


class Phrases:
    """The distinct phrases of some test items, coded in their own vocabulary, and the items of each."""

    def __init__(self, items: Iterable[tuple[int, str]], length: int) -> None:
        self.length = length
        self.code: dict[str, int] = {}
        found: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            w = words(text)
            if len(w) < length:
                continue
            codes = [self.code.setdefault(x, len(self.code) + _OTHER + 1) for x in w]
            for i in range(len(codes) - length + 1):
                found[tuple(codes[i : i + length])].add(item)
        self.rows = np.array(list(found), np.int64).reshape(-1, length)
        self.items = [sorted(x) for x in found.values()]

    @property
    def symbols(self) -> int:
        return len(self.code) + _OTHER + 1


class _Shard:
    """Runs of known words of some documents, laid end to end with a mark of no word between."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.starts: list[int] = []
        self.owner: list[int] = []
        self.offset: list[int] = []
        self.docs: list[tuple[int, str]] = []
        self.chars = 0

    def add(self, doc: int, text: str, codes: list[int], length: int) -> None:
        n = len(codes)
        known = np.array(codes) != _OTHER
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
        runs = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= length]
        if not n or not runs:
            return
        for a, b in runs:
            self.starts.append(len(self.codes))
            self.owner.append(len(self.docs))
            self.offset.append(a)
            self.codes.extend(codes[a:b])
            self.codes.append(_OTHER)
        self.docs.append((doc, text))
        self.chars += len(text)

    def spans(self, phrases: Phrases) -> Iterator[tuple]:
        if not self.codes:
            return
        which, place = FMIndex(np.array(self.codes), phrases.symbols).occurrences(phrases.rows)
        run = np.searchsorted(np.array(self.starts), place, side="right") - 1
        doc = np.array(self.owner)[run]
        word = place - np.array(self.starts)[run] + np.array(self.offset)[run]
        hits: dict[tuple[int, int], list[int]] = defaultdict(list)
        for d, w, p in zip(doc.tolist(), word.tolist(), which.tolist()):
            for item in phrases.items[p]:
                hits[d, item].append(w)
        last, at = None, None
        for (d, item), starts in sorted(hits.items()):
            if d != last:
                last, at = d, char_places(self.docs[d][1])
            merged: list[list[int]] = []
            for w in sorted(starts):
                if merged and w <= merged[-1][1]:
                    merged[-1][1] = w + phrases.length
                else:
                    merged.append([w, w + phrases.length])
            for a, b in merged:
                yield self.docs[d][0], item, a, b, at[0][a], at[1][b - 1]


def leaked_spans(documents: DataFrame, items: DataFrame, length: int = 12, shard_words: int = 1_000_000, shard_chars: int = 32_000_000, block_words: int = 2_000_000) -> DataFrame:
    """Where documents (doc_id, text) repeat ``length`` or more consecutive words of items (item_id, text).

    Returns doc_id, item_id, word_from, word_to (words of the document, end
    exclusive) and char_from, char_to: spans to remove, overlapping and
    touching ones of a document and item merged.

    * words are runs of letters and digits of the lower-cased text;
    * null or empty texts, and items of fewer words than ``length``: no span;
    * null ids: the row is left out; rows that repeat a doc_id each have spans; items that share wording all have theirs;
    * texts are read whole; an empty table gives no row; other columns are not read.
    """
    clean = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text")).where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = clean.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))
    out = None
    for b in range(blocks):
        rows = clean.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about block_words words
        part = _search(documents, Phrases([(r.item_id, r.text) for r in rows], length), shard_words, shard_chars)
        out = part if out is None else out.unionByName(part)
    return out


def _search(documents: DataFrame, phrases: Phrases, shard_words: int, shard_chars: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(shard: _Shard) -> Iterator[pa.RecordBatch]:
            rows = list(shard.spans(phrases))
            for lo in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo : lo + 10_000]), _SPANS)], schema=_SPANS)

        shard = _Shard()
        code = phrases.code.get
        if not len(phrases.rows):
            return
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard.add(doc, text, [code(w, _OTHER) for w in words(text)], phrases.length)
                if len(shard.codes) >= shard_words or shard.chars >= shard_chars:
                    yield from found(shard)
                    shard = _Shard()
        yield from found(shard)

    return (
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
        .where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(run, "doc_id bigint, item_id bigint, word_from bigint, word_to bigint, char_from bigint, char_to bigint")
    )

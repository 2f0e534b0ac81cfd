"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Tokenised documents give whole windows first; what is left of each goes into groups of some windows' worth. A group
is divided by differencing: every piece starts as a partition with one filled window, and
the two partitions of the largest imbalance are merged again and again, the fullest
window of one with the emptiest of the other, which leaves near-equal windows. Where
a window exceeds the capacity the window count rises; where that would leave too much padding, pieces
are cut in halves and the group is divided anew.

Groups are formed where the documents are read, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..operators._plan import spread

WINDOW = 2048
#: The id that ends every document.
END_ID = 1
#: Windows' worth of pieces that are divided at a time.
GROUP = 64
#: Share of windows beyond the fewest possible that a group may use before its pieces are cut.
SLACK = 0.01
#: Pieces of up to so many ids are not cut further.
SHORTEST = 32
#: Distinct words whose ids a task remembers before the memory is emptied, and the longest that is remembered.
REMEMBER, LONGEST = 300_000, 64
#: Characters of a text that are tokenised at a time.
STRETCH = 1 << 20
#: Before a blank that follows a visible character the tokenizer's own pattern always ends a word.
CUT = re.compile(r"(?<=\S)(?= )")
#: Where this occurs, blanks alone do not tell the words.
TWO = re.compile(r"\s ")


# Fixed value: the pattern of byte-level tokenizers that ends words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_names() -> dict[str, int]:
    """The characters by which a byte-level vocabulary names bytes: visible ones themselves, others from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(others)}


class CachedTokenizer:
    """Ids of texts by a tokenizer file, as little-endian unsigned 32-bit bytes.

    A byte-level BPE file whose merges stand in the order of their ids (checked here) means the same as a
    table of ranks, which merges faster than the file's own library; a text is cut where the pattern ends a
    word anyway, and the ids of a word are worked out once. Other files, and texts with one of the
    file's special strings, go to its own library. Special tokens are not added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ranked = _ranked(spec)
        # words (the blank before them left off) of now and of before; what is used again moves up
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if self.ranked is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(text) <= 2 * STRETCH:
            return self._ids(text)
        parts, at = [], 0
        while at < len(text):
            found = CUT.search(text, at + STRETCH)
            to = found.start() if found else len(text)
            parts.append(self._ids(text[at:to]))
            at = to
        return b"".join(parts)

    def _ids(self, text: str) -> bytes:
        if TWO.search(text):
            words = CUT.split(text)
            words[1:] = [w[1:] for w in words[1:]]
        else:
            words = text.split(" ")
        head = np.array(self.ranked[0].encode_ordinary(words[0]), "<u4").tobytes()
        del words[0]
        known = self.known
        try:
            return head + b"".join([known[w] for w in words])
        except KeyError:
            pass
        if len(known) > REMEMBER:
            self.older, self.known = known, {}
            known = self.known
        missing = set(words).difference(known)
        self._look_up(missing)
        ids = head + b"".join([known[w] for w in words])
        for w in missing:
            if len(w) > LONGEST:
                del known[w]
        return ids

    def _look_up(self, words: set[str]) -> None:
        """Ids of words that follow a blank: of all new ones at once, told apart by their length in bytes."""
        known, older = self.known, self.older
        engine, lengths = self.ranked
        new = []
        for w in words:
            if w in older:
                known[w] = older[w]
            elif not w or w[-1].isspace():  # at the end of a text
                known[w] = np.array(engine.encode_ordinary(" " + w), "<u4").tobytes()
            else:
                new.append(w)
        if new:
            ids = np.array(engine.encode_ordinary(" " + " ".join(new)), "<u4")
            ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in new])
            last = 4 * (np.searchsorted(np.cumsum(lengths[ids]), ends) + 1)
            raw, at = ids.tobytes(), 0
            for w, to in zip(new, last.tolist()):
                known[w] = raw[at:to]
                at = to


def _ranked(spec: dict):
    """(engine, byte length of each id) of a byte-level BPE file that means the same as a table of ranks, else None."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
             and not spec.get("normalizer") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")))
    if not plain:
        return None
    vocab, names = model["vocab"], _byte_names()
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in merged or merged != sorted(merged) or len(vocab) != 256 + len(merged) or merged[:1] != [256]:
        return None
    import tiktoken
    ranks = {bytes(names[c] for c in token): i for token, i in vocab.items()}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        lengths[i] = len(token)
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


_TOKENIZERS: dict[str, CachedTokenizer] = {}


def _tokenizer(path: str) -> CachedTokenizer:
    """One for all tasks of a worker, so that its words are worked out once."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = CachedTokenizer(path)
    return _TOKENIZERS[path]


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, int]:
    """The window of each size under multiway differencing, and the largest sum."""
    n = len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        loads, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        loads[0], nodes[0] = size, i
        heap.append((-size, i, loads, nodes))
    heapq.heapify(heap)
    merges, next_node = [], n
    while len(heap) > 1:
        _, _, la, na = heapq.heappop(heap)
        _, serial, lb, nb = heapq.heappop(heap)
        loads, nb = la + lb[::-1], nb[::-1]
        both = (na >= 0) & (nb >= 0)
        nodes = np.maximum(na, nb)
        k = int(both.sum())
        if k:
            merges.append((next_node, na[both], nb[both]))
            nodes[both] = np.arange(next_node, next_node + k)
            next_node += k
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        loads -= loads[-1]
        heapq.heappush(heap, (-int(loads[0]), serial, loads, nodes[order]))
    owner = np.full(next_node, -1, np.int64)
    if heap:
        nodes = heap[0][3]
        owner[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    for at, a, b in reversed(merges):
        owner[a] = owner[b] = owner[at:at + len(a)]
    owner = owner[:n]
    return owner, int(np.bincount(owner, weights=sizes, minlength=windows).max()) if n else 0


def divide(sizes: list[int], capacity: int = WINDOW, slack: float = SLACK, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Near-equal windows of ``(piece, from, to)`` for pieces of up to ``capacity``, none above it.

    Pieces stay whole if at most ``slack`` windows more than needed hold them, and are else
    cut into halves, quarters and so on down to ``shortest``."""
    if not sizes:
        return []
    fewest = -(-sum(sizes) // capacity)
    most = fewest + int(fewest * slack)
    limit = capacity
    while True:
        cuts = [(i, a, min(a + limit, n)) for i, n in enumerate(sizes) for a in range(0, n, limit)]
        parts = [b - a for _, a, b in cuts]
        last = limit // 2 < shortest
        windows = fewest
        while windows <= most or last:
            owner, largest = differencing(parts, windows)
            if largest <= capacity:
                out: list[list[tuple[int, int, int]]] = [[] for _ in range(windows)]
                for w, cut in zip(owner.tolist(), cuts):
                    out[w].append(cut)
                return [w for w in out if w]
            # the count rises by what the excess asks for
            windows = max(windows + 1, min(most, -(-windows * largest // capacity)))
        limit //= 2


class Packer:
    """Collects documents and gives out rows of full groups: (doc, start, length, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, group: int, first_sequence: int):
        self.capacity, self.room = capacity, group * capacity
        self.sequence, self.held, self.size = first_sequence, [], 0

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for at in range(0, whole, self.capacity):
            yield doc, at, self.capacity, ids[4 * at:4 * (at + self.capacity)], total, self.sequence, 0
            self.sequence += 1
        if total > whole:
            self.held.append((doc, whole, ids[4 * whole:], total))
            self.size += total - whole
            if self.size >= self.room:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        for window in divide([len(h[2]) // 4 for h in self.held], self.capacity):
            offset = 0
            for i, a, b in window:
                doc, start, ids, total = self.held[i]
                yield doc, start + a, b - a, ids[4 * a:4 * b], total, self.sequence, offset
                offset += b - a
            self.sequence += 1
        self.held, self.size = [], 0


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """``(id, start, length, ids, doc_tokens, sequence_id, offset)``: one row per piece of a document.

    ``tokenizer`` is the path of a tokenizer file that every executor has. ``ids`` is the piece as little-endian
    unsigned 32-bit numbers, ``doc_tokens`` its document's ids with the end id, ``start`` the ids of the document before
    the piece, ``offset`` the ids of its sequence before it. No sequence exceeds ``window``.

    A null or empty text is the end id alone. Rows are documents of their own, whatever their ids: repeated rows come
    as often, a null id comes back null. A very long text is tokenised in stretches and fills windows
    of its own; an empty table gives an empty one. Other columns are ignored. A task ends with one group
    that may be small, so its padding is less than a window beyond the group's slack."""
    rows = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    id_type = rows.schema["id"].dataType
    schema = StructType([StructField(id_col, id_type), StructField("start", LongType()), StructField("length", LongType()),
                         StructField("ids", BinaryType()), StructField("doc_tokens", LongType()),
                         StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(tokenizer)
        packer = Packer(window, group, TaskContext.get().partitionId() << 33)
        end, out, kind = np.array([end_id], "<u4").tobytes(), [], None

        def flushed() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                for row in packer.add(doc.as_py(), encoder.encode(text) + end):
                    out.append(row)
                    if len(out) >= 1024:
                        yield flushed()
        out += packer.flush()
        if out:
            yield flushed()
    return rows.mapInArrow(pack, schema)


def pack_report(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """``pack_documents`` with the CRC-32 of each piece's ids instead of the ids."""
    packed = pack_documents(docs, tokenizer, **options)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

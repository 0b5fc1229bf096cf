"""Packing of token sequences by Karmarkar-Karp multiway differencing (operator 3).

Every task reads its rows in blocks of about ``BLOCK_WINDOWS`` windows of
tokens and packs each block on its own: no shuffle, and memory bounded by the
block.  A document longer than a window is cut into full windows, which need
no packing, and a rest.  The rests of a block are dealt to k windows by
differencing: rests are cut into parts of at most ``PART`` tokens; every part
starts as a partition of its own (one filled window, k-1 empty ones); the two
partitions with the largest imbalance are merged, fullest window onto emptiest,
until one partition is left.  k starts at the fewest windows that can hold the
block.  While a window exceeds the capacity, parts are cut at window edges and
dealt anew, and after ``ROUNDS`` of that the number of windows rises until all
fit.

Results on odd input: a null or empty text is the closing id alone; texts of
any length are cut, never shortened; repeated rows are packed once each; an
empty table gives no pieces; other columns are not read.  Sequence ids are
unique and depend on how rows are dealt to tasks, as Spark's own
``monotonically_increasing_id`` does; a retried task deals its rows alike as
long as its input does.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import give_back, slices

CAPACITY = 4096
CLOSING_ID = 2
BLOCK_WINDOWS = 512
#: Rests that one block holds at most, so that a block of tiny documents stays quick to pack.
BLOCK_RESTS = 4096
#: Longest part into which a rest is cut before packing.
PART = 512
#: How often parts are cut at window edges before a block takes one more window.
ROUNDS = 4
#: Bytes of words that a worker process remembers.
MEMORY = 192 << 20

SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Remembered:
    """Values by key, of at most about twice ``most_bytes`` of keys and values.

    New entries go to ``now``.  When that is full it becomes ``before``, whose
    entries are taken over as they are met again, so frequent ones stay.
    """

    #: Bytes that an entry costs besides the characters of its key and value.
    ENTRY = 160

    def __init__(self, most_bytes: int):
        self.most_bytes = most_bytes
        self.now: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.size = 0

    def put(self, key: bytes, value: bytes) -> None:
        self.now[key] = value
        self.size += len(key) + len(value) + self.ENTRY

    def again(self, key: bytes) -> bytes | None:
        """The value of a key that is not in ``now``, or None."""
        value = self.before.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def trim(self) -> None:
        if self.size > self.most_bytes:
            self.before, self.now, self.size = self.now, {}, 0


class WordTokens:
    """ids of a text by the tokenizer file, looked up by space-separated word.

    The tokenizer drops white space and never merges across it, so a text's
    ids are those of its words.  A word of plain letters followed by plain
    punctuation is looked up in two parts, which go to the tokenizer's own BPE
    model when they are new and skip the normaliser.  Parts are remembered across
    the tasks of a worker process, within ``memory`` bytes.
    """

    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    PLAIN = re.compile(f"[{LETTERS}]*")
    MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        low = [c for c in map(chr, range(33, 256)) if c.lower() == c and re.match(f"[{self.LETTERS}!-~]", c)]
        self.spelled = {ord(c): spell(c)[0][0] for c in low}
        self.parts = Remembered(memory // 2)
        # added tokens stand for themselves; one that could lie inside a simple word rules that path out
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.simple = not any(self._letters(t) is not None for t in added)

    def _letters(self, word: bytes) -> bytes | None:
        """The plain letters that begin a word of them and plain punctuation; None for other words."""
        letters = word.rstrip(self.MARKS)
        return letters if self.PLAIN.fullmatch(letters.decode()) else None

    def _part(self, part: bytes) -> bytes:
        if not part:
            return b""
        found = self.tokenizer.model.tokenize(part.decode().lower().translate(self.spelled))
        ids = array("I", [t.id for t in found]).tobytes()
        self.parts.put(part, ids)
        return ids

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        self.parts.trim()
        known, out, odd = self.parts.now, [], []
        for i, w in enumerate(words):
            letters = w.rstrip(self.MARKS)
            ids = known.get(letters) or self.parts.again(letters)
            if ids is None:
                if not self.simple or not self.PLAIN.fullmatch(letters.decode()):
                    odd.append(i)
                    out.append(b"")
                    continue
                ids = self._part(letters)
            if len(letters) < len(w):
                marks = w[len(letters):]
                ids += known.get(marks) or self.parts.again(marks) or self._part(marks)
            out.append(ids)
        for i, e in zip(odd, self.tokenizer.encode_batch([words[i].decode() for i in odd], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out

    def ids(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; every distinct word of ``texts`` is looked up once."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()).fill_null(""))
        coded = split.flatten().dictionary_encode()
        found = self._ids_of(coded.dictionary.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy()
        per = sizes[word]
        ends = np.concatenate(([0], np.cumsum(per)))
        at = np.arange(ends[-1]) + np.repeat(starts[word] - ends[:-1], per)
        raw = np.frombuffer(b"".join(found), "<u4")[at].tobytes()
        first = split.offsets[0].as_py()
        cut = 4 * ends[split.offsets.to_numpy() - first]
        return [raw[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist())]


@lru_cache(maxsize=2)
def word_tokens(path: str, memory: int = MEMORY) -> WordTokens:
    return WordTokens(path, memory)


def differencing(sizes: list[int], k: int) -> tuple[list[int], int]:
    """(window of each size, fullest window) for ``k`` windows."""
    n = len(sizes)
    if k == 1 or n == 0:
        return [0] * n, sum(sizes)
    if n == 1:
        return [0], sizes[0]
    # a partition: its loads, largest first; only filled windows are kept, the rest are empty
    loads: list[np.ndarray] = [np.array([s]) for s in sizes]
    origin: list[tuple] = [()] * n  # of a merge: the two partitions and where their windows went
    first, second = np.zeros(1, np.int32), np.ones(1, np.int32)
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        la, lb = loads[a], loads[b]
        na, nb = len(la), len(lb)
        if na == nb == 1:  # two sizes, the larger first
            loads[a] = loads[b] = None
            loads.append(np.concatenate((la, lb)))
            origin.append((a, b, first, second))
            heapq.heappush(heap, (int(lb[0] - la[0]) if k == 2 else -int(la[0]), len(loads) - 1))
            continue
        width = min(k, na + nb)
        merged = np.zeros(width, np.int64)
        merged[:na] += la
        merged[width - nb:] += lb[::-1]  # the fullest of b goes onto the emptiest of a
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        place = np.empty(width, np.int32)
        place[order] = np.arange(width, dtype=np.int32)
        loads[a] = loads[b] = None
        loads.append(merged)
        origin.append((a, b, place[:na], place[width - nb:][::-1]))
        floor = merged[-1] if width == k else 0
        heapq.heappush(heap, (int(floor - merged[0]), len(loads) - 1))
    root = heap[0][1]
    fullest = int(loads[root][0])
    window = [0] * n
    todo = [(root, np.arange(len(loads[root]), dtype=np.int32))]
    while todo:
        node, at = todo.pop()
        if node < n:
            window[node] = int(at[0])
            continue
        a, b, pa_, pb = origin[node]
        todo.append((a, at[pa_]))
        todo.append((b, at[pb]))
    return window, fullest


def pack_block(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """(window of each size, number of windows): the windows' number rises while one exceeds the capacity.

    Sizes are at most ``capacity`` and stay whole.
    """
    k = -(-sum(sizes) // capacity)
    while True:
        window, fullest = differencing(sizes, k)
        if fullest <= capacity:
            return window, k
        k += 1


def cut_block(sizes: list[int], capacity: int) -> tuple[list[list[tuple[int, int]]], int]:
    """((window, length) of the parts of each size, number of windows).

    Sizes are first cut into parts of ``PART``, which differencing deals to as
    few windows as can hold the sum.  While a window exceeds the capacity, a
    part of it is cut at its edge and all parts are dealt anew; if ``ROUNDS``
    such cuts do not do, the number of windows rises.
    """
    parts = [(i, min(PART, s - at)) for i, s in enumerate(sizes) for at in range(0, s, PART)]
    k = -(-sum(sizes) // capacity)
    for _ in range(ROUNDS):
        window, fullest = differencing([n for _, n in parts], k)
        if fullest <= capacity:
            break
        parts = _cut_at_edges(parts, window, k, capacity)
    else:
        window, k = pack_block([n for _, n in parts], capacity)
    out: list[list[tuple[int, int]]] = [[] for _ in sizes]
    for (i, n), w in zip(parts, window):
        if out[i] and out[i][-1][0] == w:  # neighbours in one window are one piece
            n += out[i].pop()[1]
        out[i].append((w, n))
    return out, k


def _cut_at_edges(parts: list[tuple[int, int]], window: list[int], k: int, capacity: int) -> list[tuple[int, int]]:
    """The parts, of each window that is too full one cut in two where the window ends."""
    load = [0] * k
    for (_, n), w in zip(parts, window):
        load[w] += n
    out = []
    for (i, n), w in zip(parts, window):
        over = load[w] - capacity
        if 0 < over < n:
            out += [(i, n - over), (i, over)]
            load[w] = 0
        else:
            out.append((i, n))
    return out


class _Block:
    def __init__(self, capacity: int):
        self.capacity = capacity
        self.docs: list[tuple] = []
        self.tokens = self.rests = 0

    def add(self, doc_id, ids: bytes) -> None:
        self.docs.append((doc_id, ids))
        self.tokens += len(ids) // 4
        self.rests += 1

    def full(self) -> bool:
        return self.tokens >= BLOCK_WINDOWS * self.capacity or self.rests >= BLOCK_RESTS

    def pieces(self, first_sequence: int) -> tuple[list[tuple], int]:
        """Piece rows and the next free sequence id."""
        cap, out, seq, rests = self.capacity, [], first_sequence, []
        for d, (doc_id, ids) in enumerate(self.docs):
            total = len(ids) // 4
            for start in range(0, total - total % cap, cap):
                out.append((doc_id, start, cap, total, seq, 0, ids[4 * start:4 * (start + cap)]))
                seq += 1
            if total % cap:
                rests.append((d, total % cap))
        parts, k = cut_block([r for _, r in rests], cap)
        filled = [0] * k
        for (d, size), own in zip(rests, parts):
            doc_id, ids = self.docs[d]
            total = len(ids) // 4
            start = total - size
            for w, n in own:
                out.append((doc_id, start, n, total, seq + w, filled[w], ids[4 * start:4 * (start + n)]))
                filled[w] += n
                start += n
        return out, seq + k


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, closing_id: int = CLOSING_ID, memory: int = MEMORY) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset and ids
    (the piece's token ids as little-endian unsigned 32-bit numbers).  ``memory`` bounds
    the bytes of word parts that a worker process remembers."""
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[0].dataType.simpleString()
    closing = np.array([closing_id], "<u4").tobytes()

    def run(batches):
        task = TaskContext.get()
        seq = (task.partitionId() if task else 0) << 33
        tokens = word_tokens(tokenizer, memory)
        block = _Block(capacity)
        give_back()
        for batch in batches:
            arrow_id = batch.schema.field(0).type
            for part in slices(batch, [1], 1 << 20):
                for doc_id, ids in zip(part.column(0).to_pylist(), tokens.ids(part.column(1))):
                    block.add(doc_id, ids + closing)
                    if block.full():
                        out, seq = block.pieces(seq)
                        yield _to_arrow(out, arrow_id, id_col)
                        block, out = _Block(capacity), None
            batch = part = None
            give_back()
        if block.docs:
            out, seq = block.pieces(seq)
            yield _to_arrow(out, arrow_id, id_col)

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, {SCHEMA}")


def _to_arrow(rows: list[tuple], id_type, id_col: str) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [id_type] + [pa.int64()] * 5 + [pa.binary()]
    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

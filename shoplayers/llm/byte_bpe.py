"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

The pre-tokenizer is the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?letters+| ?numbers+| ?(other signs)+|white space not before a sign|white space

but no regular expression runs over texts. A text becomes an array of code points, every code point a symbol:
its class, and for white space, apostrophe contractions and the like what the next code point says about it.
Over symbols the pattern is a machine of eight states, and a token begins where the pair (state, symbol) says
so. The state before every symbol comes from an associative scan: a symbol is a function from states to
states, functions compose, and the finitely many compositions have numbers with a multiplication table. The scan
walks a table of rows side by side, one column a step, then scans the products of the rows in the same way. Texts
of a group are scanned together, with a symbol between them that forgets the state; a longer text is scanned in
blocks of `BLOCK` code points, each handing its last state to the next.

Slices between boundaries, as bytes, are merged pair by pair in order of rank: those of a group that are new
side by side, long ones by a heap in O(n log n). Merged slices are kept in a cache of at most `CACHE` slices a task. Every token keeps the
offset of its first byte, so any stretch of tokens can be traced to its text; decoding gathers the tokens'
bytes from one array by their offsets, for all texts of a batch at once.

Letters, numbers and white space are what the library that defines the results takes for them; its own tables are
read on the driver once. These classes (a byte per code point) and the vocabulary's file (about a megabyte; its
path is a parameter) are all that is broadcast.

Defined results: a NULL text is empty; an empty text has no tokens. Special tokens are ordinary text. Bytes that
are no UTF-8 are read as U+FFFD. Very long texts are encoded whole, with about 12 bytes of memory a code point and 24 a token beside
those of a block. Unknown ids, and NULL among ids, decode to nothing; a NULL list to no bytes. Rows come out as
often as they came in; an empty table gives an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplayers.llm.common import type_of

BLOCK = 1 << 20
GROUP_CHARS = 1 << 18
SLICES = 1 << 17
BETWEEN = 0xD800  # no text holds a lone surrogate: it stands between texts
CACHE = 1 << 17
ROW_WIDTHS = (8, 16, 32)  # bytes; longer slices are merged one by one
# --- Fixed values: lower-case letters that follow an apostrophe in a contraction -------------------
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE, END = range(7)  # BLANK is U+0020, END lies between texts


# --- classes ---------------------------------------------------------------------------------------


def character_classes() -> bytes:
    """The class of every code point, from the tables of the library whose results are to be equalled."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}

    def members(pattern: str) -> np.ndarray:
        # What a pattern does not match yields no tokens.
        probe = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = probe.decode_bytes(probe.encode_ordinary(every))
        return np.frombuffer(matched.decode("utf-8").encode("utf-32-le"), np.uint32)

    classes = np.full(0x110000, OTHER, np.uint8)
    classes[members(r"\p{L}")] = LETTER
    classes[members(r"\p{N}")] = NUMBER
    classes[members(r"\s")] = SPACE
    classes[ord(" ")] = BLANK
    classes[ord("'")] = QUOTE
    classes[BETWEEN] = END
    return classes.tobytes()


# --- symbols and states ----------------------------------------------------------------------------

# Symbols: what a code point is, given the next one.
_SYMBOLS = (
    "letter", "number", "other", "quote",
    "space",  # white space before white space or the end
    "joined",  # U+0020 before anything else: it begins that token
    "single",  # other white space before anything else
    "short",  # a letter that ends a contraction after an apostrophe
    "long",  # a letter that, with the next, ends one
    "end",
)
(_LETTER, _NUMBER, _OTHER, _QUOTE, _SPACE, _JOINED, _SINGLE, _SHORT, _LONG, _END) = range(len(_SYMBOLS))
# States: what came before.
FRESH, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _IN_SPACE, _AFTER_JOINED, _AFTER_QUOTE, _IN_CONTRACTION = range(8)
_STATES = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token begins at the symbol."""
    if symbol == _END:
        return FRESH, True
    if state == _IN_CONTRACTION:
        return FRESH, False
    if state == _AFTER_QUOTE and symbol == _SHORT:
        return FRESH, False
    if state == _AFTER_QUOTE and symbol == _LONG:
        return _IN_CONTRACTION, False
    joined = state == _AFTER_JOINED
    if symbol in (_LETTER, _SHORT, _LONG):
        return _IN_LETTERS, not (joined or state == _IN_LETTERS)
    if symbol == _NUMBER:
        return _IN_NUMBERS, not (joined or state == _IN_NUMBERS)
    if symbol in (_OTHER, _QUOTE):
        begins = not (joined or state in (_IN_OTHERS, _AFTER_QUOTE))
        return (_AFTER_QUOTE if begins and symbol == _QUOTE else _IN_OTHERS), begins
    if symbol == _SPACE:
        return _IN_SPACE, state != _IN_SPACE
    return (_AFTER_JOINED if symbol == _JOINED else FRESH), True


@dataclass(frozen=True)
class _Machine:
    """All compositions of the symbols' functions: their values, their products, and where tokens begin."""

    values: np.ndarray  # [element, state before] -> state after
    products: np.ndarray  # [first, second] -> element
    of_symbol: np.ndarray  # [symbol] -> element
    begins: np.ndarray  # [state before, symbol]
    identity: int


def _build_machine() -> _Machine:
    generators = [tuple(_step(state, symbol)[0] for state in range(_STATES)) for symbol in range(len(_SYMBOLS))]
    known = {tuple(range(_STATES)): 0}
    queue = list(known)
    for function in queue:  # grows while it is read
        for generator in generators:
            then = tuple(generator[state] for state in function)
            if then not in known:
                known[then] = len(known)
                queue.append(then)
    values = np.array(queue, np.uint8)
    # The product of elements a and b takes a state through a, then through b.
    products = np.array([[known[tuple(b[state] for state in a)] for b in queue] for a in queue], np.uint16)
    begins = np.array([[_step(state, symbol)[1] for symbol in range(len(_SYMBOLS))] for state in range(_STATES)])
    return _Machine(values, products, np.array([known[g] for g in generators], np.uint16), begins, 0)


_MACHINE = _build_machine()


def prefix_products(elements: np.ndarray) -> np.ndarray:
    """For every place the product of all elements before it, and one more for all: an associative scan."""
    machine = _MACHINE
    total = len(elements)
    if total <= 64:
        out = np.empty(total + 1, np.uint16)
        out[0] = machine.identity
        for place in range(total):
            out[place + 1] = machine.products[out[place], elements[place]]
        return out
    width = max(8, 1 << (total.bit_length() // 2))
    rows = -(-total // width)
    table = np.zeros(rows * width, np.uint16)  # the identity is element 0
    table[:total] = elements
    columns = np.ascontiguousarray(table.reshape(rows, width).T)
    flat, size = machine.products.reshape(-1), len(machine.products)
    held = np.zeros(rows, np.int64)
    before = np.empty((width, rows), np.uint16)
    for place in range(width):
        before[place] = held
        held = flat[held * size + columns[place]].astype(np.int64)
    carried = prefix_products(held.astype(np.uint16)).astype(np.int64)
    out = np.empty(total + 1, np.uint16)
    out[:total] = flat[carried[:-1, None] * size + before.T].reshape(-1)[:total]
    out[total] = carried[-1]
    return out


def symbols_of(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The symbol of every code point; the end follows the last one."""
    kinds = classes[points]
    next_kind = np.r_[kinds[1:], np.uint8(END)]
    next_point = np.r_[points[1:], np.uint32(BETWEEN)]
    of_class = np.array([_LETTER, _NUMBER, _OTHER, _SPACE, _SPACE, _QUOTE, _END], np.uint8)
    symbols = of_class[kinds]
    before_sign = (next_kind != SPACE) & (next_kind != BLANK) & (next_kind != END)
    symbols[(kinds == BLANK) & before_sign] = _JOINED
    symbols[(kinds == SPACE) & before_sign] = _SINGLE
    for ending in CONTRACTIONS:
        first = points == ord(ending[0])
        if len(ending) == 1:
            symbols[first] = _SHORT
        else:
            symbols[first & (next_point == ord(ending[1]))] = _LONG
    return symbols


def boundaries(points: np.ndarray, classes: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Where tokens begin, in code points; places between texts are boundaries of their own."""
    found, state = [], FRESH
    for begin in range(0, len(points), block):
        # One point beyond the block says what its last one is.
        symbols = symbols_of(points[begin : begin + block + 1], classes)[:block]
        states = _MACHINE.values[prefix_products(_MACHINE.of_symbol[symbols]), state]
        found.append(np.flatnonzero(_MACHINE.begins[states[:-1], symbols]) + begin)
        state = int(states[-1])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def byte_places(points: np.ndarray, wanted: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Where code points begin in UTF-8; `wanted` ascends and may name the end."""
    found, held = [], 0
    for begin in range(0, len(points) + 1, block):
        part = points[begin : begin + block]
        widths = 1 + (part >= 0x80).astype(np.uint8) + (part >= 0x800) + (part >= 0x10000)
        upto = np.r_[0, np.cumsum(widths, dtype=np.int64)] + held
        low, high = np.searchsorted(wanted, (begin, begin + block))
        found.append(upto[wanted[low:high] - begin])
        held = int(upto[-1])
    return np.concatenate(found)


# --- merging ---------------------------------------------------------------------------------------


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}


class PairRanks:
    """What two neighbouring tokens merge to: a table of bytes for the first round, then sorted pairs of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values()) + 1
        firsts, seconds, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                first, second = ranks.get(token[:cut]), ranks.get(token[cut:])
                if first is not None and second is not None:
                    firsts.append(first)
                    seconds.append(second)
                    merged.append(rank)
        keys = np.array(firsts, np.int64) * (self.none + 1) + np.array(seconds, np.int64)
        order = np.argsort(keys)
        self.keys = np.r_[keys[order], np.iinfo(np.int64).max]
        self.merged = np.r_[np.array(merged, np.int32)[order], np.int32(self.none)]
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        every = np.repeat(self.bytes, 256), np.tile(self.bytes, 256)
        self.byte_pairs = self.of(*every)

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The id two tokens merge to, which is its rank; `none` if they don't (`none` merges with nothing)."""
        wanted = first.astype(np.int64) * (self.none + 1) + second
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.merged[at], np.int32(self.none))


@dataclass(frozen=True)
class Merged:
    """Token ids of slices: `ids` holds those of slice s from `starts[s]` on, `sizes[s]` of them."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray


def merge_many(pieces: Sequence[bytes], ranks: dict[bytes, int], pairs: PairRanks) -> Merged:
    """In every slice, of all neighbours the pair of lowest rank, leftmost first, is joined until none can be.

    Slices of like length take a step at a time side by side, as rows of a table that finished rows leave.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    pool, held = [], 0
    starts, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)

    def add(rows: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        nonlocal held
        pool.append(ids)
        sizes[rows] = counts
        starts[rows] = held + np.cumsum(counts) - counts
        held += len(ids)

    for shorter, width in zip((0, *ROW_WIDTHS), ROW_WIDTHS):
        rows = np.flatnonzero((lengths > shorter) & (lengths <= width))
        for begin in range(0, len(rows), 1 << 14):
            part = rows[begin : begin + (1 << 14)]
            data = np.frombuffer(b"".join([pieces[row].ljust(width, b"\x00") for row in part.tolist()]), np.uint8)
            add(part, *_merge_rows(data.reshape(-1, width), lengths[part], pairs))
    for row in np.flatnonzero(lengths > ROW_WIDTHS[-1]).tolist():
        ids = np.array(merge_long(pieces[row], ranks), np.int32)
        add(np.array([row]), ids, np.array([len(ids)]))
    return Merged(np.concatenate(pool) if pool else np.empty(0, np.int32), starts, sizes)


def _merge_rows(data: np.ndarray, sizes: np.ndarray, pairs: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after another, and how many each row has."""
    width = data.shape[1]
    places = np.arange(width)
    ranks = pairs.byte_pairs[data[:, :-1].astype(np.int64) * 256 + data[:, 1:]]
    ranks[places[None, 1:] >= sizes[:, None]] = pairs.none
    ids = pairs.bytes[data]
    done, counts = np.empty_like(ids), sizes.copy()
    rows = np.arange(len(data))
    while True:
        at = ranks.argmin(axis=1)
        line = np.arange(len(rows))
        best = ranks[line, at]
        open_ = best < pairs.none
        if not open_.all():
            done[rows[~open_]] = ids[~open_]
            rows, ids, ranks, at, best = rows[open_], ids[open_], ranks[open_], at[open_], best[open_]
            line = line[: len(rows)]
        if not len(rows):
            return done[places[None, :] < counts[:, None]], counts
        counts[rows] -= 1
        # What follows the pair moves on by one place; the merged token takes the first one's.
        moved = places[None, :] > at[:, None]
        ids[:, :-1] = np.where(moved[:, :-1], ids[:, 1:], ids[:, :-1])
        ids[line, at] = best
        ranks[:, :-1] = np.where(moved[:, :-2], ranks[:, 1:], ranks[:, :-1])
        ranks[:, -1] = pairs.none
        next_ = np.minimum(at + 1, width - 1)
        ranks[line, np.minimum(at, width - 2)] = pairs.of(best, np.where(at + 1 < counts[rows], ids[line, next_], pairs.none))
        before = np.flatnonzero(at)
        ranks[before, at[before] - 1] = pairs.of(ids[before, at[before] - 1], best[before])


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same for one long slice, with a heap of pairs and a chain of parts; a pair is stale once one of its
    parts has changed."""
    ends = list(range(1, len(piece) + 1))  # of the part that begins here
    after = list(range(1, len(piece) + 1))
    before = list(range(-1, len(piece) - 1))
    alive = bytearray(b"\x01") * len(piece)
    heap: list[tuple[int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(piece):
            rank = ranks.get(piece[left : ends[right]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, ends[left], ends[right]))

    for left in range(len(piece) - 1):
        offer(left)
    while heap:
        _, left, middle, end = heapq.heappop(heap)
        right = after[left]
        if not alive[left] or ends[left] != middle or right >= len(piece) or ends[right] != end:
            continue
        alive[right] = 0
        ends[left] = end
        after[left] = after[right]
        if after[right] < len(piece):
            before[after[right]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    found, at = [], 0
    while at < len(piece):
        found.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return tuple(found)


class Cache:
    """Slices with the place of their ids in a growing table."""

    def __init__(self, size: int):
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.table = Merged(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))

    def add(self, pieces: Sequence[bytes], merged: Merged) -> None:
        known, held = len(self.table.starts), len(self.table.ids)
        self.places.update(zip(pieces, range(known, known + len(pieces))))
        self.table = Merged(
            np.r_[self.table.ids, merged.ids], np.r_[self.table.starts, merged.starts + held], np.r_[self.table.sizes, merged.sizes]
        )

    def trim(self) -> None:
        """Forget everything once there are too many slices or ids."""
        if len(self.places) > self.size or len(self.table.ids) > 16 * self.size:
            self.clear()


class Encoder:
    """Encodes groups of texts with one vocabulary and one cache of merged slices."""

    def __init__(self, vocabulary: bytes, classes: bytes, cache: int = CACHE, block: int = BLOCK):
        self.ranks = ranks_of(vocabulary)
        self.pairs = PairRanks(self.ranks)
        self.classes = np.frombuffer(classes, np.uint8)
        self.cache, self.block = Cache(cache), block
        self.lengths = np.zeros(self.pairs.none, np.int64)
        self.lengths[list(self.ranks.values())] = list(map(len, self.ranks))

    def _merge(self, pieces: Sequence[bytes]) -> Merged:
        """Slices that are tokens as they are, and merged ones."""
        merged = merge_many(pieces, self.ranks, self.pairs)
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int64, len(pieces))
        tokens = np.flatnonzero(whole >= 0)
        merged.starts[tokens] = len(merged.ids) + np.arange(len(tokens))
        merged.sizes[tokens] = 1
        return Merged(np.r_[merged.ids, whole[tokens].astype(np.int32)], merged.starts, merged.sizes)

    def _ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slices one after another, and how many each has."""
        cache = self.cache
        place = np.fromiter(map(cache.places.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(place < 0)
        if len(new):
            missing = [pieces[i] for i in new.tolist()]
            fresh = list(dict.fromkeys(missing))
            cache.add(fresh, self._merge(fresh))
            place[new] = np.fromiter(map(cache.places.__getitem__, missing), np.int64, len(missing))
        counts = cache.table.sizes[place]
        shift = np.repeat(cache.table.starts[place] - (np.cumsum(counts) - counts), counts)
        ids = cache.table.ids[np.arange(len(shift)) + shift]
        cache.trim()
        return ids, counts

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after another, the offset of every token's first byte in its own text, and
        the number of tokens of every text."""
        joined = "".join(part for text in texts for part in (text, chr(BETWEEN)))
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = boundaries(points, self.classes, self.block)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1  # places between texts
        edges = byte_places(points, np.r_[begins, len(points)], self.block)
        del points
        data = joined.encode("utf-8", "surrogatepass")
        del joined
        own = ~np.isin(begins, ends, assume_unique=True)
        starts, stops = edges[:-1][own], edges[1:][own]
        last = np.searchsorted(begins[own], ends)  # slices up to the end of every text
        parts, counts = [], [np.zeros(1, np.int64)]
        for begin in range(0, len(starts), SLICES):
            here = slice(begin, begin + SLICES)
            ids, sizes = self._ids_of([data[a:b] for a, b in zip(starts[here].tolist(), stops[here].tolist())])
            parts.append(ids)
            counts.append(sizes)
        ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
        upto = np.cumsum(np.concatenate(counts))[last]  # tokens up to the end of every text
        sizes = np.diff(np.r_[0, upto])
        # Tokens of a text follow each other without gaps, so their offsets are sums of lengths.
        places = np.r_[0, np.cumsum(self.lengths[ids])]
        return ids, places[:-1] - np.repeat(places[upto - sizes], sizes), sizes


def _grouped(texts: Iterator[str], size: int) -> Iterator[list[str]]:
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def encode(
    docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text", offsets: bool = True
) -> DataFrame:
    """One row per input row: id, ids and (with `offsets`) the offset of every token's first byte in the text."""
    context = docs.sparkSession.sparkContext
    shared, classes = context.broadcast(vocabulary), context.broadcast(character_classes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, classes.value)
        for batch in batches:
            at = 0
            texts = ((text.as_py() or b"").decode("utf-8", "replace") for text in batch.column(1))
            for group in _grouped(texts, GROUP_CHARS):
                ids, places, sizes = encoder.encode(group)
                edges = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
                columns = [batch.column(0).slice(at, len(group)), pa.ListArray.from_arrays(edges, pa.array(ids))]
                if offsets:
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(places, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)
                at += len(group)

    names = ["id", "ids", "offsets"][: 3 if offsets else 2]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = f"id {type_of(docs, id_col)}, ids array<int>" + (", offsets array<long>" if offsets else "")
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)


# --- decoding --------------------------------------------------------------------------------------


class Decoder:
    """Bytes of tokens, gathered from one array that holds all tokens one after another."""

    def __init__(self, vocabulary: bytes):
        ranks = ranks_of(vocabulary)
        tokens = [b""] * (max(ranks.values()) + 2)  # the last one is empty, for unknown ids
        for token, rank in ranks.items():
            tokens[rank] = token
        self.unknown = len(tokens) - 1
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens' bytes one after another, and the end of every token in them."""
        ids = np.where((ids >= 0) & (ids < self.unknown), ids, self.unknown)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.data[np.arange(len(shift)) + shift], ends


def decoded(ids: Column, vocabulary: bytes, spark: SparkSession) -> Column:
    """The bytes that a column of id lists stands for."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(shared.value)
        for lists in batches:
            cells = []
            edges = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            at = 0
            for group in _runs(edges, SLICES):  # so that a batch of long lists needs no more memory than its longest
                size = int(group.sum())
                data, ends = decoder.decode(numbers[at : at + size])
                at += size
                whole = data.tobytes()
                stops = np.r_[0, ends][np.cumsum(group)].tolist()
                cells += [whole[a:b] for a, b in zip([0, *stops], stops)]
            yield pa.array(cells, pa.binary())

    return run(ids)


def _runs(sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """`sizes` in runs that add up to about `most`."""
    if len(sizes):
        number = (np.cumsum(sizes) - sizes) // most
        yield from np.split(sizes, np.flatnonzero(np.diff(number)) + 1)


def digests(encoded: DataFrame, vocabulary: bytes, id_col: str = "doc_id") -> DataFrame:
    """One row per encoded row: id, n_tokens, ids_sha256 and decoded_sha256 (of the bytes decoded from the ids)."""
    back = decoded(F.col("ids"), vocabulary, encoded.sparkSession)
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(back, 256).alias("decoded_sha256"),
    )

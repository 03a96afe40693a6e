"""Packing of token pieces into sequences of bounded length by cutting-stock column generation.

Documents are cut into full pieces and one remainder. Short remainders of equal length travel in
bundles of up to ``GRID`` pieces, chosen so that hardly a token is lost when the bundle's length is
rounded up to ``GRID`` tokens. Bundles are a histogram of at most capacity / GRID classes, whatever
the corpus size. A linear program over cutting patterns is solved on it by the revised simplex
method; a knapsack recursion over the duals prices new patterns. Pattern counts are rounded down,
what is left is packed first-fit, largest first. Every piece gets a rank among those of its length,
and the rank alone says which bundle, sequence and place in the pattern is its own.

The program is solved on the driver in plain numpy arithmetic, without calls of native linear
algebra, whose threads may not live in a process that also started a JVM. Its pivots are bounded,
and stalls are ended by preferring small amounts first (see ``solve``).

Defined cases: a null text is empty and has the end id alone; a document of full pieces only has
no remainder; rows that repeat an id are pieces of their own; null ids are packed as well; an
empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.common import slices, text_rows
from stepwise.session import stored

CAPACITY = 4096
GRID = 8
#: Bytes of text encoded at once, and parts a worker keeps: it may share its memory with what earlier stages left.
TEXT_BYTES, KEEP_PARTS = 2 << 20, 600_000
#: A bundle may lose this share of its tokens to rounding; beyond ``BUNDLE_TOKENS`` pieces go alone.
BUNDLE_LOSS, BUNDLE_TOKENS = 1 / 400, 256
#: The linear program ends when no more than this share above its lower bound.
GAP = 2e-3
#: Pivots after which the inverse is computed anew, and at most in all, as a multiple of the classes.
FRESH_PIVOTS, MOST_PIVOTS = 1000, 20
#: The program also ends when so many pivots together save less than this share of the bins.
STALL_PIVOTS, STALL = 200, 2e-4
#: Pieces of one length within which ranks are counted; longer lists get more buckets.
RANK_ROWS = 1 << 16


def token_pieces(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, with_ids: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, and on demand their ids."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches):
        from stepwise.llm.words import encoder, with_end

        library = encoder(tokenizer, KEEP_PARTS)
        for part in slices(batches, "text", TEXT_BYTES):
            ids, counts = with_end(*library.encode(part.column("text")), end)
            pieces = -(-counts // capacity)
            owner = np.repeat(np.arange(len(counts)), pieces)
            first = np.cumsum(pieces) - pieces
            start = (np.arange(len(owner)) - first[owner]) * capacity
            length = np.minimum(counts[owner] - start, capacity)
            raw = memoryview(ids.astype("<u4").tobytes())
            ends = np.cumsum(length)
            sums = [zlib.crc32(raw[a:b]) for a, b in zip((4 * (ends - length)).tolist(), (4 * ends).tolist())]
            cols = [part.column("doc_id").take(pa.array(owner)), *map(pa.array, (start, length)), pa.array(sums, pa.int64()), pa.array(counts[owner])]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(cols, names)
            pa.default_memory_pool().release_unused()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return text_rows(docs, key, text).mapInArrow(run, schema)


def knapsack(sizes: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items that fits: its worth and the count of each item."""
    by_size = np.full(room + 1, -np.inf)
    by_size[sizes] = worth
    best, last = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for space in range(1, room + 1):
        value = by_size[1 : space + 1] + best[space - 1 :: -1] if space > 1 else by_size[1:2]
        top = int(value.argmax())
        if value[top] > best[space - 1] + 1e-12:
            best[space], last[space] = value[top], top + 1
        else:
            best[space] = best[space - 1]
    counts, space = np.zeros(room + 1, np.int64), room
    while space > 0:
        if last[space]:
            counts[last[space]] += 1
        space -= int(last[space]) or 1
    return float(best[room]), counts[sizes]


def invert(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination with row exchange, in plain array arithmetic."""
    n = len(matrix)
    both = np.hstack([matrix.astype(float), np.eye(n)])
    for i in range(n):
        top = i + int(np.abs(both[i:, i]).argmax())
        if abs(both[top, i]) < 1e-12:
            raise ArithmeticError("singular basis")
        if top != i:
            both[[i, top]] = both[[top, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= factor[:, None] * both[i]
    return both[:, n:]


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> list[tuple[float, np.ndarray]]:
    """Fractional pattern counts that cover the demand with nearly the fewest bins.

    A leaving pattern is the one with the least ratio and, of equal ones, the least index (Bland's
    choice). Any basis reached is feasible, so the bound on pivots costs bins, never right results.
    """
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    amount = demand / np.diag(basis)
    bound, mark = 0.0, np.inf
    for step in range(1, MOST_PIVOTS * m + 1):
        dual = inverse.sum(axis=0)
        worth, pattern = knapsack(sizes, dual, room)
        bound = max(bound, float((demand * dual).sum()) / max(worth, 1.0))
        if worth <= 1 + 1e-9 or amount.sum() <= bound * (1 + gap):
            break
        if step % STALL_PIVOTS == 0:
            if amount.sum() > mark * (1 - STALL):
                break
            mark = amount.sum()
        enter = (inverse * pattern).sum(axis=1)
        ratio = np.where(enter > 1e-9, amount / np.where(enter > 1e-9, enter, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        if step % FRESH_PIVOTS == 0:
            inverse = invert(basis)
            amount = np.maximum((inverse * demand).sum(axis=1), 0)
        else:
            row = inverse[out] / enter[out]
            inverse -= enter[:, None] * row
            inverse[out] = row
            moved = ratio[out]
            amount = np.maximum(amount - moved * enter, 0)
            amount[out] = moved
    return [(float(x), basis[:, i].round().astype(np.int64)) for i, x in enumerate(amount)]


def bundle_size(length: int, grid: int = GRID, most: int = BUNDLE_TOKENS) -> int:
    """How many pieces of one length go together: the fewest that lose little, at most ``grid``."""
    loss = lambda k: (-(-k * length // grid) * grid - k * length) / (k * length)
    options = [k for k in range(1, grid + 1) if k == 1 or k * length <= most]
    return next((k for k in options if loss(k) <= BUNDLE_LOSS), min(options, key=loss))


def bundles(lengths: dict[int, int], grid: int = GRID, most: int = BUNDLE_TOKENS) -> tuple[dict[int, int], dict[int, tuple[int, int, int, int, int]]]:
    """Histogram of bundle classes, and per length (bundle size, class, first rank, class of the rest, rank of the rest).

    Of the pieces of a length, the last ones that fill no bundle are a smaller bundle of their own.
    """
    histogram: dict[int, int] = {}
    where: dict[int, tuple[int, int, int, int, int]] = {}
    for length, count in sorted(lengths.items()):
        each = bundle_size(length, grid, most)
        whole, rest = divmod(count, each)
        kind, rest_kind = -(-each * length // grid), -(-rest * length // grid)
        first = histogram.get(kind, 0)
        histogram[kind] = first + whole
        rest_first = histogram.get(rest_kind, 0)
        if rest:
            histogram[rest_kind] = rest_first + 1
        where[length] = (each, kind, first, rest_kind, rest_first)
    return {c: n for c, n in histogram.items() if n}, where


def patterns(histogram: dict[int, int], room: int, gap: float = GAP) -> list[tuple[int, dict[int, int]]]:
    """Whole pattern counts that have a place for every piece: (count, {class: pieces of it})."""
    found: list[tuple[int, dict[int, int]]] = []
    if full := histogram.get(room, 0):
        found.append((full, {room: 1}))
    sizes = np.array(sorted(c for c, n in histogram.items() if c < room and n), np.int64)
    demand = np.array([histogram[int(c)] for c in sizes], np.float64)
    left = demand.astype(np.int64)
    for amount, pattern in sorted(solve(sizes, demand, room, gap), key=lambda p: -p[0]):
        used = np.flatnonzero(pattern)
        whole = int(amount + 1e-6)
        if len(used) and whole:
            whole = min(whole, int((left[used] // pattern[used]).min()))  # no place stays empty
        if whole:
            found.append((whole, {int(sizes[i]): int(pattern[i]) for i in used}))
            left -= whole * pattern
    bins: list[tuple[int, dict[int, int]]] = []  # (room left, content): first fit, largest first
    for size, count in zip(sizes[::-1].tolist(), left[::-1].tolist()):
        for i, (space, content) in enumerate(bins):
            take = min(count, space // size)
            if take:
                content[size] = content.get(size, 0) + take
                bins[i] = (space - take * size, content)
                count -= take
            if not count:
                break
        while count:
            take = min(count, room // size)
            bins.append((room - take * size, {size: take}))
            count -= take
    return found + [(1, content) for _, content in bins]


def places(chosen: list[tuple[int, dict[int, int]]], room: int) -> dict[int, np.ndarray]:
    """Per class the rows (rank after the last, first rank, pieces per sequence, first sequence)."""
    rows: dict[int, list] = {}
    sequence = 0
    for count, pattern in chosen:
        for size, pieces in pattern.items():
            own = rows.setdefault(size, [])
            first = own[-1][0] if own else 0
            own.append((first + count * pieces, first, pieces, sequence))
        sequence += count
    return {size: np.array(own, np.int64) for size, own in rows.items()}


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY, grid: int = GRID, gap: float = GAP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    ``order`` are columns that tell pieces apart. ``pieces`` is read several times: pass a
    stored table. The driver sees the histogram of lengths alone, at most ``capacity`` numbers.
    """
    grid = math.gcd(grid, capacity)
    room = capacity // grid
    lengths = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    histogram, where = bundles(lengths, grid, min(BUNDLE_TOKENS, capacity // 4))
    table = places(patterns(histogram, room, gap), room)
    spread = {n: -(-c // RANK_ROWS) for n, c in lengths.items() if c > RANK_ROWS}
    parts = F.lit(1)
    if spread:  # at most ``capacity`` entries
        known = F.create_map(*(F.lit(v) for pair in sorted(spread.items()) for v in pair))
        parts = F.coalesce(F.element_at(known, F.col("length").cast("int")), F.lit(1))
    sized = pieces.withColumn("__bucket", F.pmod(F.xxhash64(*order), parts.cast("long")))
    counts = stored(sized.groupBy("length", "__bucket").agg(F.count("*").alias("__n")), "pack-counts")
    earlier = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    within = Window.partitionBy("length", "__bucket").orderBy(*order)
    ranked = sized.withColumn("__rank", F.row_number().over(within)).join(offsets, ["length", "__bucket"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__rank") - 1)
    columns = pieces.columns
    schema = ranked.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("__slot")).schema

    def assign(batches):
        for batch in batches:
            size, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "__rank"))
            sequence, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for length in np.unique(size).tolist():
                each, kind, first, rest_kind, rest_first = where[length]
                own = np.flatnonzero(size == length)
                bundle, place = rank[own] // each, rank[own] % each
                last = bundle == lengths[length] // each
                for c, picked, number in ((kind, ~last, first + bundle), (rest_kind, last, np.full(len(own), rest_first))):
                    if not picked.any():
                        continue
                    number = number[picked]
                    rows = table[c][np.searchsorted(table[c][:, 0], number, "right")]
                    past = number - rows[:, 1]
                    sequence[own[picked]] = rows[:, 3] + past // rows[:, 2]
                    slot[own[picked]] = (past % rows[:, 2] - c * (capacity + 1)) * grid + place[picked]
            cols = [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(cols, [*columns, "sequence_id", "__slot"])

    placed = ranked.select(*columns, "__rank").mapInArrow(assign, schema)
    before = Window.partitionBy("sequence_id").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("__slot")


def pack_documents(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their places. Only lengths and checksums are shuffled, no ids."""
    pieces = stored(token_pieces(docs, tokenizer, end, capacity, key=key, text=text), "pieces")
    return pack(pieces, ["doc_id", "start", "ids_crc32", "doc_tokens"], capacity)

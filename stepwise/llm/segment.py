"""Sampled SentencePiece segmentations without replacement, and decoding.

The lattice of a text has its characters as nodes and vocabulary pieces as edges; characters
without a piece of their own fall back to bytes. A segmentation's weight is the product of its
pieces' weights, which fall with the rank of the piece. Gumbel noise on all segmentations ranks
them, and the best ``k`` are drawn exactly by a best-first search that never lists them: backward
sums turn the lattice into conditional edge probabilities; following drawn edges keeps a node's
perturbed value; the edges left aside at a step are one set with the truncated value of its
mass, kept in a queue. The best set is opened next, and the value left on top after ``k``
segmentations is the threshold of the inclusion scores.

Blanks never stand behind another sign of a piece, so a run of blanks and the word after it are
a part, and parts are walked side by side for a whole slice of texts. All noise is a hash of row key, sample, part and step: results
do not depend on partitions or batches.

Defined cases: null and empty texts have one segmentation without pieces; a text with fewer than
``k`` segmentations gives all of them, with inclusion 1; the sign that stands for a blank is read
as a blank; a null key is a key like others; rows that repeat key and text repeat their samples.
"""

from __future__ import annotations

import heapq
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from stepwise.llm.common import ragged, slices, text_rows

BLANK = "▁"
#: Weight of a piece: 1 / (rank + OFFSET) ** SHARPNESS, as word frequencies fall.
OFFSET, SHARPNESS = 2.7, 1.0
#: Scores below are of pieces that were given by hand; the number ranks them as it ranks the merges.
LEAST_SCORE = -1e8
SLICE = 4 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stirred(seed: np.ndarray, *parts) -> np.ndarray:
    """A seed that has taken in some parts."""
    with np.errstate(over="ignore"):
        for part in parts:
            seed = _mix(seed * _MUL + np.asarray(part).astype(np.uint64) + np.uint64(1))
    return seed


def uniform(seed: np.ndarray, *parts) -> np.ndarray:
    """Numbers in (0, 1) that seed and parts decide."""
    return ((stirred(seed, *parts) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


class Pieces:
    """The vocabulary of a model file: hashes of pieces and their beginnings by length, weights, and bytes for decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        scores = np.array([model.get_score(i) for i in range(size)])
        self.size = size
        self.weight = -SHARPNESS * np.log(np.maximum(-scores, 0) + OFFSET)
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        byte_value = {int(i): b for b, i in enumerate(self.byte_id)}
        control = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        spelled = [bytes([byte_value[i]]) if i in byte_value else b"" if control[i] else n.replace(BLANK, " ").encode() for i, n in enumerate(names)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array([len(s) for s in spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_size) - self.spelled_size
        usable = [i for i in range(size) if i not in byte_value and not control[i]]
        first = next(i for i in usable if scores[i] > LEAST_SCORE)
        by_hand = np.flatnonzero(scores <= LEAST_SCORE)
        self.weight[by_hand] = -SHARPNESS * np.log(np.maximum(by_hand - first - scores[first], 0) + OFFSET)
        self.byte_weight = float(min(self.weight[i] for i in usable if names[i] != BLANK))
        self.weight[[i for i in by_hand if names[i] == BLANK]] = self.byte_weight
        self.longest = max(len(names[i]) for i in usable)
        # Every beginning of a piece, by length: its hash, the piece it is (or -1), whether a longer piece starts so.
        found: list[dict[int, list]] = [{} for _ in range(self.longest + 1)]
        for i in usable:
            codes = np.frombuffer(names[i].encode("utf-32-le"), np.uint32)
            value = np.zeros(1, np.uint64)
            for n in range(1, len(codes) + 1):
                value = self.hashes(value, codes[n - 1 : n])
                entry = found[n].setdefault(int(value[0]), [-1, False])
                if n == len(codes):
                    entry[0] = i
                else:
                    entry[1] = True
        self.keys, self.whole, self.ids, self.longer, self.heads, self.shift = {}, {}, {}, {}, {}, {}
        for n, entries in enumerate(found[1:], 1):
            order = sorted(entries)
            self.keys[n] = np.array(order, np.uint64)
            self.whole[n] = np.array([entries[h][0] for h in order], np.int64)
            self.ids[n] = self.whole[n][self.whole[n] >= 0]
            self.longer[n] = np.array([entries[h][1] for h in order], bool)
            # Where keys with given leading bits begin; eight values of these bits for every key.
            bits = len(order).bit_length() + 3
            self.shift[n] = np.uint64(64 - bits)
            self.heads[n] = np.searchsorted(self.keys[n] >> self.shift[n], np.arange((1 << bits) + 1).astype(np.uint64))

    def find(self, n: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes of ``n`` codes begin a piece, and their places in the table."""
        keys, heads = self.keys[n], self.heads[n]
        slot = (values >> self.shift[n]).astype(np.int64)
        place, stop = heads[slot], heads[slot + 1]
        hit = np.zeros(len(values), bool)
        look = np.flatnonzero(place < stop)
        while len(look):
            same = keys[place[look]] == values[look]
            hit[look[same]] = True
            look = look[~same]
            place[look] += 1
            look = look[place[look] < stop[look]]
        which = np.flatnonzero(hit)
        return which, place[which]

    @staticmethod
    def hashes(before: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Hashes of sequences that are one code longer than those before."""
        with np.errstate(over="ignore"):
            value = (before ^ codes.astype(np.uint64)) * _MUL
            return value ^ (value >> np.uint64(29))

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of a segmentation, without the blank that every text starts with."""
        return self.spelled[ragged(self.spelled_start[ids], self.spelled_size[ids])].tobytes()[1:]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """Edges of distinct parts, grouped by start node, with probabilities given the node.

    A part of n characters (blank signs first) has n + 1 nodes; nodes of all parts are numbered
    through. Piece numbers from ``vocabulary.size`` on are characters to be spelled in bytes.
    """

    def __init__(self, vocabulary: Pieces, parts: list[str]):
        joined = "".join(parts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        length = np.array([len(p) for p in parts], np.int64)
        stop = np.cumsum(length)
        part = np.repeat(np.arange(len(parts)), length)
        left = np.repeat(stop, length) - np.arange(len(codes))  # characters to the end of the part
        starts, names = [], []
        edges_of = np.zeros(len(codes) + 1, np.int64)
        missing = np.ones(len(codes), bool)
        at, value = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for n in range(1, min(vocabulary.longest, int(length.max(initial=0))) + 1):
            value = vocabulary.hashes(value, codes[at + (n - 1)])
            which, place = vocabulary.find(n, value)
            at, value, ids = at[which], value[which], vocabulary.whole[n][place]
            whole = ids >= 0
            starts.append(at[whole])
            names.append(ids[whole])
            edges_of[starts[-1]] += 1
            if n == 1:
                missing[starts[0]] = False
            going = np.flatnonzero(vocabulary.longer[n][place] & (left[at] > n))
            at, value = at[going], value[going]
        alone = np.flatnonzero(missing)
        edges_of[alone] += 1
        odd, which = np.unique(codes[alone], return_inverse=True)
        self.odd = [chr(c).encode(errors="surrogatepass") for c in odd]
        # Numbers of pieces, then of the bytes of each such character.
        self.spelled = np.concatenate([np.arange(vocabulary.size), *(vocabulary.byte_id[list(c)] for c in self.odd)])
        self.spelled_size = np.array([len(c) for c in self.odd], np.int64)
        self.spelled_start = np.cumsum(self.spelled_size) - self.spelled_size
        odd_weight = np.array([vocabulary.byte_weight * len(c) for c in self.odd])
        # Edges in the order of their starts, shorter pieces first: every list holds a start once, so places follow by counting.
        free = np.cumsum(edges_of) - edges_of
        edges = int(edges_of.sum())
        self.size, self.name, weight = np.empty(edges, np.int64), np.empty(edges, np.int64), np.empty(edges)
        for n, (at, ids) in enumerate(zip(starts, names), 1):
            place = free[at]
            free[at] += 1
            self.size[place], self.name[place], weight[place] = n, ids, vocabulary.weight[ids]
        place = free[alone]
        self.size[place], self.name[place], weight[place] = 1, vocabulary.size + which, odd_weight[which]
        start = np.repeat(np.arange(len(codes)), edges_of[:-1])
        node = start + part[start]
        total = np.zeros(len(codes) + len(parts))
        edge_left = left[start]
        small = edge_left.astype(np.uint16) if length.max(initial=0) < 1 << 16 else edge_left  # short numbers sort by digits
        by_left = np.argsort(small, kind="stable")
        edge_left = edge_left[by_left]
        cuts = np.flatnonzero(np.diff(edge_left, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(edge_left)]):
            edges = by_left[a:b]
            own = node[edges]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[first]] = np.logaddexp.reduceat(weight[edges] + total[own + self.size[edges]], first)
        self.node = node
        self.logp = weight + total[node + self.size] - total[node]
        self.first = np.searchsorted(node, np.arange(len(total) + 1))
        share = np.exp(np.minimum(self.logp, 0))
        summed = np.cumsum(share)
        heads = self.first[:-1][node]
        self.reach = summed - (summed[heads] - share[heads])
        last = self.first[1:][node] - 1
        self.reach[last] = np.inf  # rounding never leads past the last edge
        self.share = share
        # What is left of a node beside one edge; of a single edge nothing.
        self.aside = np.where(self.first[1:][node] - heads > 1, np.log(np.maximum(-np.expm1(np.minimum(self.logp, 0)), 1e-300)), -np.inf)
        self.part_start = stop - length + np.arange(len(parts))
        self.part_end = self.part_start + length
        opening = np.zeros(len(total) + 1, bool)
        opening[self.part_start] = True
        self.opens = opening[node]  # edges at the start of a part

    def walk(self, node: np.ndarray, part: np.ndarray, seed: np.ndarray, place: np.ndarray, sample: np.ndarray):
        """Follow drawn edges from each node to the end of its part. Returns the edges in order and their number per walk."""
        origin, end = self.part_start[part], self.part_end[part]
        seed = stirred(seed, sample, place)
        live = np.flatnonzero(node < end)
        now = node[live]
        steps, walks = [], []
        while len(live):
            chance = uniform(seed[live], now - origin[live])
            edge = self.first[now].copy()
            look = np.flatnonzero(chance >= self.reach[edge])
            while len(look):
                edge[look] += 1
                look = look[chance[look] >= self.reach[edge[look]]]
            steps.append(edge)
            walks.append(live)
            now = now + self.size[edge]
            going = now < end[live]
            live, now = live[going], now[going]
        count = np.zeros(len(node), np.int64)
        for w in walks:
            count[w] += 1
        offset = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        for i, (edge, w) in enumerate(zip(steps, walks)):
            out[offset[w] + i] = edge
        return out, count


def _gumbel(location, chance):
    return location - np.log(-np.log(chance))


def _below(bound, value):
    """A value truncated at a bound."""
    return -np.logaddexp(-bound, -value)


class Search:
    """Best-first search of one text. Queue entries: (-value, order, path, step, edges already taken there)."""

    def __init__(self, lattice: Lattice, seed: int):
        self.lattice, self.seed = lattice, np.array([seed], np.uint64)
        self.queue: list = []
        self.found: list = []  # (path, log probability, value)
        self.order = 0

    def _push(self, value: float, path: np.ndarray, step: int, taken: tuple) -> None:
        if np.isfinite(value):
            self.order += 1
            heapq.heappush(self.queue, (-value, self.order, path, step, taken))

    def take(self, path: np.ndarray, value: float, values: np.ndarray, from_step: int, keep: int) -> None:
        """A finished path, and the values of what was left aside from a step on; only the best can still matter."""
        self.found.append((path, float(self.lattice.logp[path].sum()), value))
        best = np.argpartition(-values, keep)[:keep] if len(values) > keep else np.arange(len(values))
        for i in best.tolist():
            self._push(float(values[i]), path, from_step + i, (int(path[from_step + i]),))

    def open(self, sample: int):
        """Open the best set: the path up to and with its drawn edge, and the value; none if nothing is left."""
        if not self.queue:
            return None
        value, _, path, step, taken = heapq.heappop(self.queue)
        lat, value = self.lattice, -value
        node = int(lat.node[path[step]])
        edges = [e for e in range(lat.first[node], lat.first[node + 1]) if e not in taken]
        mass = np.cumsum(lat.share[edges])
        chance = uniform(self.seed, [sample], [step], [1 << 40])[0] * mass[-1]
        edge = edges[min(int(np.searchsorted(mass, chance, "right")), len(edges) - 1)]
        rest = float(mass[-1] - lat.share[edge])
        if len(edges) > 1 and rest > 0:
            location = float(lat.logp[path[:step]].sum()) + np.log(rest)
            noise = _gumbel(location, uniform(self.seed, [sample], [step], [1 << 41])[0])
            self._push(float(_below(value, noise)), path, step, (*taken, edge))
        return np.append(path[:step], edge), value


def sample_slice(vocabulary: Pieces, keys: list, texts: pa.Array, k: int):
    """Per text a list of (ids, log probability, perturbed value, log inclusion)."""
    texts = pc.replace_substring(texts, BLANK, " ")
    spelled = pc.binary_join_element_wise(BLANK, pc.replace_substring(texts, " ", BLANK), "")
    # No blank is left to stand in a text, so one marks where each run of blank signs begins.
    marked = pc.replace_substring(spelled, BLANK, " " + BLANK)
    for _ in range(2):  # the first pass joins signs of a run in pairs, the second the pairs
        marked = pc.replace_substring(marked, f"{BLANK} {BLANK}", BLANK * 2)
    split = pc.split_pattern(pc.utf8_slice_codeunits(marked, 1), " ")
    offsets = np.asarray(split.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    coded = split.flatten().dictionary_encode()
    part = np.asarray(coded.indices).astype(np.int64)
    empty = np.asarray(pc.equal(pc.binary_length(texts), 0))
    lattice = Lattice(vocabulary, coded.dictionary.to_pylist())
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    place = np.arange(len(part)) - offsets[:-1][owner]
    seeds = np.array([xxhash.xxh64_intdigest(str(key)) for key in keys], np.uint64)
    searches = [Search(lattice, int(s)) for s in seeds]

    def finish(prefix: dict[int, tuple], sample: int) -> None:
        """Walk on from each text's prefix (path, value) and hand the results to the searches."""
        rows = np.array(sorted(prefix), np.int64)
        node, where, own, spot = [], [], [], []
        for i in rows.tolist():
            path, a, b = prefix[i][0], offsets[i], offsets[i + 1]
            if empty[i]:
                continue
            resume = a
            if len(path):  # the part in which the prefix ends
                here = int(lattice.node[path[-1]] + lattice.size[path[-1]])
                resume = a + prefix[i][2]
                node.append([here])
                where.append(part[resume : resume + 1])
                own.append([i])
                spot.append(place[resume : resume + 1])
                resume += 1
            node.append(lattice.part_start[part[resume:b]])
            where.append(part[resume:b])
            own.append(np.full(b - resume, i))
            spot.append(place[resume:b])
        if not node:
            node = where = own = spot = [np.zeros(0, np.int64)]
        node, where, own, spot = (np.concatenate(x).astype(np.int64) for x in (node, where, own, spot))
        edges, count = lattice.walk(node, where, seeds[own], spot, np.full(len(node), sample))
        steps = np.bincount(own, count, len(texts)).astype(np.int64)[rows]
        stops = np.cumsum(steps)
        starts = stops - steps
        gone = np.array([len(prefix[i][0]) for i in rows.tolist()], np.int64)
        step = np.arange(len(edges)) + np.repeat(gone - starts, steps)
        chance = uniform(np.repeat(stirred(seeds[rows], np.uint64(sample)), steps), step, np.uint64(1 << 42))
        logp = lattice.logp[edges]
        passed = np.empty(len(edges))
        for i, a, b in zip(rows.tolist(), starts.tolist(), stops.tolist()):
            np.cumsum(logp[a:b], out=passed[a:b])
            passed[a:b] += float(lattice.logp[prefix[i][0]].sum())
        passed -= logp
        values = _below(np.repeat([prefix[i][1] for i in rows.tolist()], steps), _gumbel(passed + lattice.aside[edges], chance))
        for i, a, b in zip(rows.tolist(), starts.tolist(), stops.tolist()):
            path, value = prefix[i][:2]
            searches[i].take(np.concatenate([path, edges[a:b]]), value, values[a:b], len(path), k)

    none = np.zeros(0, np.int64)
    top = _gumbel(0.0, uniform(seeds, np.zeros(len(seeds)), np.zeros(len(seeds)), np.full(len(seeds), 1 << 43)))
    with np.errstate(divide="ignore", over="ignore"):
        finish({i: (none, float(top[i]), 0) for i in range(len(texts))}, 0)
        for sample in range(1, k):
            opened = {}
            for i, search in enumerate(searches):
                if found := search.open(sample):
                    opened[i] = (*found, int(lattice.opens[found[0]].sum()) - 1)
            finish(opened, sample)
        return [[_result(vocabulary, lattice, search, *f) for f in search.found] for search in searches], texts


def _result(vocabulary: Pieces, lattice: Lattice, search: Search, path: np.ndarray, logp: float, value: float):
    ids = lattice.name[path]
    if len(ids) and ids.max() >= vocabulary.size:
        odd = np.flatnonzero(ids >= vocabulary.size)
        which = ids[odd] - vocabulary.size
        runs = np.ones(len(ids), np.int64)
        runs[odd] = lattice.spelled_size[which]
        first = (np.cumsum(runs) - runs)[odd]
        ids = np.repeat(ids, runs)
        ids[ragged(first, runs[odd])] = lattice.spelled[ragged(vocabulary.size + lattice.spelled_start[which], runs[odd])]
    over = logp + search.queue[0][0] if search.queue else np.inf  # queue values are negated: location less threshold
    inclusion = np.log(-np.expm1(-np.exp(min(over, 50.0)))) if over > -30 else over
    return ids, logp, value, float(inclusion)


def sample_segmentations(docs: DataFrame, model: str, k: int, with_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Up to ``k`` distinct segmentations per row, best perturbed value first.

    Returns doc_id, sample, n_pieces, log_prob, perturbed, log_inclusion, ids_crc32 (ids as
    little-endian unsigned 32-bit numbers), round_trip (decoding gives the text), and on demand ids.
    """
    names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "round_trip"] + ["ids"] * with_ids

    def run(batches):
        vocabulary = pieces_of(model)
        for part in slices(batches, "text", SLICE):
            keys = part.column("doc_id").to_pylist()
            results, texts = sample_slice(vocabulary, keys, part.column("text"), k)
            rows = []
            for ident, value, found in zip(keys, texts.to_pylist(), results):
                raw = value.encode()
                for n, (ids, logp, perturbed, inclusion) in enumerate(found, 1):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    row = (ident, n, len(ids), logp, perturbed, inclusion, crc, vocabulary.decode(ids) == raw)
                    rows.append((*row, ids) if with_ids else row)
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3 + [pa.int64(), pa.bool_()] + [pa.list_(pa.int64())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    schema = (
        "doc_id long, sample long, n_pieces long, log_prob double, perturbed double, log_inclusion double, "
        "ids_crc32 long, round_trip boolean" + ", ids array<long>" * with_ids
    )
    return text_rows(docs, key, text).mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text of a column of ids. A null or empty list gives an empty text; invalid UTF-8 is replaced."""
    schema = rows.selectExpr("*", f"'' AS {out}").schema

    def run(batches):
        vocabulary = pieces_of(model)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = [vocabulary.decode(np.array(x or [], np.int64)).decode(errors="replace") for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return rows.mapInArrow(run, schema)

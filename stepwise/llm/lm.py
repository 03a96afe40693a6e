"""Document log-likelihood under a gated recurrent language model with a class-factored output.

Tokens are lower-cased words and one end per text. The most frequent words have classes by
frequency mass and a softmax inside their class; all other words, unknown ones included, have
classes by their last two bytes and inside them the smoothed share of their count. A token's
probability is that of its class given the state times that of the word inside the class.

All counts come from all training texts. The weights come from one pass over all training texts:
each task trains a copy from the same start by truncated backpropagation, and the copies are
averaged by the tokens they saw. Scoring carries the state through the windows of a text.

Words outside a bounded table of frequent ones meet their counts in a join, so the vocabulary
may grow with the corpus. Defined cases: null texts are empty and have the end alone; a null id is
held out; rows that repeat an id are scored one by one; without training texts N and V are 0;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.llm.common import slices, text_rows
from stepwise.session import shared_dir, stored

FOLDS, HELD_OUT = 7, 2
HIDDEN = 12
#: Words with a softmax of their own, classes of them, suffix classes of the others.
SOFTMAX_WORDS, WORD_CLASSES, SUFFIX_CLASSES = 2048, 32, 64
#: Words whose counts are sent to every task; the others are joined.
TABLE_WORDS = 1 << 17
#: Texts side by side, and steps of a window in training and in scoring.
SLOTS, TRAIN_STEPS, SCORE_STEPS = 512, 16, 32
RATE = 0.08
SEED = 17
END = b""
#: Distinct words after which a task hands its counts on.
FLUSH_WORDS = 400_000
_PARTS = 32


def held_out(ident: int | None) -> bool:
    return ident is None or zlib.crc32(str(ident).encode()) % FOLDS == HELD_OUT


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SUFFIX_CLASSES


@dataclass
class Vocabulary:
    """Frequent words with their counts, most frequent first, and what is known of all words."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    suffix_total: np.ndarray
    suffix_distinct: np.ndarray

    def __post_init__(self):
        n = min(len(self.words), SOFTMAX_WORDS)
        self.own = n
        mass = np.cumsum(self.counts[:n]) - self.counts[:n] / 2
        share = np.minimum((mass / max(self.counts[:n].sum(), 1) * WORD_CLASSES).astype(np.int64), WORD_CLASSES - 1)
        self.word_class = share  # ascending, since words come by frequency
        self.bounds = np.searchsorted(share, np.arange(WORD_CLASSES + 1))
        self.table = pa.array(self.words, pa.binary())

    def ranks(self, words: pa.Array) -> np.ndarray:
        """Place of each word in the table, -1 where it has none."""
        return np.asarray(pc.index_in(words, value_set=self.table).fill_null(-1)).astype(np.int64)

    def shares(self, groups, counts):
        """log10 of the shares of words without a softmax, by suffix class and count."""
        return np.log10((counts + 1) / (self.suffix_total[groups] + self.suffix_distinct[groups] + 1))

    def inside(self, word: bytes, count: int) -> float:
        return float(self.shares(suffix_class(word), count))


def training_texts(part: pa.RecordBatch) -> pa.Array:
    return part.column("text").filter(pa.array([not held_out(i) for i in part.column("doc_id").to_pylist()], pa.bool_()))


def count_words(rows: DataFrame) -> DataFrame:
    """(word, n) over all training texts."""

    def merged(seen):
        both = pa.concat_tables(seen)
        return both if len(seen) < 2 else both.group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def run(batches):
        seen, held = [], 0
        for part in slices(batches, "text"):
            texts = training_texts(part)
            if not len(texts):
                continue
            places, _, distinct = coded(texts)
            seen.append(pa.table({"word": distinct, "n": np.bincount(places, minlength=len(distinct))}))
            held += len(distinct)
            if held > FLUSH_WORDS:
                both = merged(seen)
                seen, held = [both], len(both)
                if held > FLUSH_WORDS // 2:  # merging again would gain little
                    yield from both.to_batches()
                    seen, held = [], 0
        if seen:
            yield from merged(seen).to_batches()

    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _suffix(word: str):
    return F.pmod(F.crc32(F.expr(f"substring({word}, -2, 2)")), F.lit(SUFFIX_CLASSES)).cast("int")


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """``counts`` is a stored table; at most ``TABLE_WORDS`` rows and a row per class reach the driver."""
    by_class = counts.groupBy(_suffix("word").alias("g")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    total, distinct = np.zeros(SUFFIX_CLASSES, np.int64), np.zeros(SUFFIX_CLASSES, np.int64)
    for row in by_class:
        total[row["g"]], distinct[row["g"]] = row["n"], row["v"]
    # Frequent words: all above the lowest size class of counts that leaves no more than TABLE_WORDS.
    size = F.floor(F.log2("n") * 64)
    classes = sorted(counts.groupBy(size.alias("s")).agg(F.count("*").alias("v")).collect(), reverse=True)
    room, least = TABLE_WORDS, None
    for row in classes:
        room -= row["v"]
        if room < 0:
            break
        least = row["s"]
    top = counts.where(F.lit(False) if least is None else size >= least).toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["n", "word"], ascending=[False, True])
    words, n = top["word"].tolist(), top["n"].to_numpy(np.int64)
    sums = int(total.sum()), int(distinct.sum())
    for word, count in zip(words[:SOFTMAX_WORDS], n[:SOFTMAX_WORDS].tolist()):
        g = suffix_class(word)
        total[g], distinct[g] = total[g] - count, distinct[g] - 1
    return Vocabulary(words, n, *sums, total, distinct)


class Model:
    """Gated recurrent unit whose input table holds the gates' inputs; float32 throughout."""

    NAMES = ("table", "recur", "out", "out_bias", "word_out", "word_bias")

    def __init__(self, vocabulary: Vocabulary, hidden: int = HIDDEN):
        v, h = vocabulary, hidden
        self.hidden, self.vocabulary = h, v
        random = np.random.default_rng(SEED)
        normal = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
        classes = WORD_CLASSES + SUFFIX_CLASSES
        mass = np.concatenate([np.bincount(v.word_class, v.counts[: v.own], WORD_CLASSES), v.suffix_total])
        self.table = normal(SOFTMAX_WORDS + SUFFIX_CLASSES, 3 * h, scale=0.3)
        self.recur = normal(h, 3 * h, scale=h**-0.5)
        self.out = normal(h, classes, scale=0.05)
        self.out_bias = np.log((mass + 0.5) / (mass.sum() + 1)).astype(np.float32)
        self.out_bias[:WORD_CLASSES][np.diff(v.bounds) == 0] = -30  # classes without words
        self.word_out = normal(SOFTMAX_WORDS, h, scale=0.05)
        self.word_bias = np.zeros(SOFTMAX_WORDS, np.float32)
        self.word_bias[: v.own] = np.log(np.maximum(v.counts[: v.own], 1))
        self.class_of = np.zeros(SOFTMAX_WORDS + SUFFIX_CLASSES, np.int64)
        self.class_of[: v.own], self.class_of[SOFTMAX_WORDS:] = v.word_class, WORD_CLASSES + np.arange(SUFFIX_CLASSES)

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        for name in self.NAMES:
            own = getattr(self, name)
            own[...] = flat[: own.size].reshape(own.shape)
            flat = flat[own.size :]

    def steps(self, state: np.ndarray, inputs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Run a window [steps, slots]. Returns the states before each step, what backpropagation needs, and the last state."""
        h, (count, slots) = self.hidden, inputs.shape
        before, gates = np.empty((count, slots, h), np.float32), np.empty((count, 3, slots, h), np.float32)
        moved = np.empty((count, 3, slots, h), np.float32)
        low, high, one = np.float32([-15, 15, 1])
        parts = np.arange(3)[None, :, None] + 3 * inputs[:, None, :]
        fed = self.table.reshape(-1, h).take(parts, axis=0)  # each gate in one piece
        recur = self.recur.reshape(h, 3, h).transpose(1, 0, 2).copy()
        # The first two gates are summed with the other sign, as their exponential wants them.
        np.negative(fed[:, :2], out=fed[:, :2])
        np.negative(recur[:2], out=recur[:2])
        # States lie in [-1, 1], so sums of weights bound what is added to the inputs.
        wide = np.abs(fed[:, :2]).max(initial=0) + np.abs(recur[:2]).sum(axis=1).max() > 15
        for prior, fresh, some, into, own, gate in zip(before, starts, starts.any(axis=1).tolist(), moved, fed, gates):
            prior[...] = state
            if some:
                prior[fresh] = 0
            np.matmul(prior, recur, out=into)
            first, last = gate[:2], gate[2]
            np.add(own[:2], into[:2], out=first)
            if wide:
                np.maximum(first, low, out=first)
                np.minimum(first, high, out=first)
            np.exp(first, out=first)
            first += one
            np.reciprocal(first, out=first)
            np.multiply(first[1], into[2], out=last)
            last += own[2]
            np.tanh(last, out=last)
            state = prior - last
            state *= first[0]
            state += last
        return before, gates, moved[:, 2], state

    def loss(self, states: np.ndarray, tokens: np.ndarray, gradient: bool):
        """Natural-log probabilities of tokens given states; with ``gradient`` also all output gradients."""
        v, n, width = self.vocabulary, len(tokens), self.out.shape[1]
        target = self.class_of[tokens]
        at_target = np.arange(n) * width + target
        scores = states @ self.out
        # States lie in [-1, 1], so column sums bound the scores; the bound serves as the shift unless it is far off.
        reach = np.abs(self.out).sum(axis=0)
        top = float((self.out_bias + reach).max())
        scores += self.out_bias - np.float32(top)
        if top - float((self.out_bias - reach).max()) > 60:
            scores -= scores.max(axis=1, keepdims=True)
        flat = scores.reshape(-1)
        picked = flat[at_target]
        np.exp(scores, out=scores)
        sums = scores.sum(axis=1, keepdims=True)
        logp = picked - np.log(sums[:, 0])
        grads = None
        if gradient:
            scores /= sums
            flat[at_target] -= 1
            grads = {"out": states.T @ scores, "out_bias": scores.sum(axis=0), "states": scores @ self.out.T}
            grads["word_out"], grads["word_bias"] = np.zeros_like(self.word_out), np.zeros_like(self.word_bias)
        # Words with a softmax of their own, class by class.
        order = np.argsort(target.astype(np.int16), kind="stable")  # a radix sort for short integers
        ends = np.searchsorted(target[order], np.arange(WORD_CLASSES + 1))
        order = order[: ends[-1]]
        group, mine = target[order], states[order]
        place = (np.arange(len(order)) - ends[group]) * np.diff(v.bounds)[group] + tokens[order] - v.bounds[group]
        hits, totals = np.zeros(len(order), states.dtype), np.ones((len(order), 1), states.dtype)
        deep = np.zeros_like(mine) if gradient else None
        for a, b, i, j in zip(v.bounds.tolist(), v.bounds[1:].tolist(), ends.tolist(), ends[1:].tolist()):
            if b - a < 2 or i == j:
                continue
            rows, weights, spots = mine[i:j], self.word_out[a:b], place[i:j]
            inner = rows @ weights.T
            inner += self.word_bias[a:b]
            inner -= np.maximum.reduce(inner, axis=1, keepdims=True)
            flat = inner.reshape(-1)
            hits[i:j] = flat[spots]
            np.exp(inner, out=inner)
            total = np.add.reduce(inner, axis=1, keepdims=True, out=totals[i:j])
            if gradient:
                inner /= total
                flat[spots] -= 1
                np.matmul(inner.T, rows, out=grads["word_out"][a:b])
                np.add.reduce(inner, axis=0, out=grads["word_bias"][a:b])
                np.matmul(inner, weights, out=deep[i:j])
        logp[order] += hits - np.log(totals[:, 0])
        if gradient:
            grads["states"][order] += deep
        return logp, grads

    def backward(self, inputs, starts, before, gates, carried, from_output) -> dict[str, np.ndarray]:
        """Gradients of the recurrent part over one window."""
        h, (count, slots) = self.hidden, inputs.shape
        by_gate, moved_grad = np.empty((count, 3, slots, h), gates.dtype), np.empty((count, slots, 3 * h), gates.dtype)
        upper = np.zeros((slots, h), np.float32)
        back = self.recur.T.copy()
        z, r, c = gates[:, 0], gates[:, 1], gates[:, 2]
        not_z, not_r, slope, gap = 1 - z, 1 - r, 1 - c * c, before - c
        some = starts.any(axis=1).tolist()
        side_by_side = moved_grad.reshape(count, slots, 3, h).transpose(0, 2, 1, 3)
        candidates = np.empty((count, slots, h), gates.dtype)
        for t in range(count - 1, -1, -1):
            candidate, (by_z, by_r, by_c) = candidates[t], by_gate[t]
            np.multiply(upper, not_z[t], out=candidate)
            candidate *= slope[t]
            np.multiply(upper, gap[t], out=by_z)
            by_z *= z[t]
            by_z *= not_z[t]
            np.multiply(candidate, carried[t], out=by_r)
            by_r *= r[t]
            by_r *= not_r[t]
            np.multiply(candidate, r[t], out=by_c)
            side_by_side[t] = by_gate[t]
            upper = upper * z[t]
            upper += moved_grad[t] @ back
            upper += from_output[t]
            if some[t]:
                upper[starts[t]] = 0
        fed_grad = moved_grad.copy()
        fed_grad[:, :, 2 * h :] = candidates
        flat = inputs.ravel()
        order = np.argsort(flat.astype(np.int16), kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        rows = flat[order[first]]
        table = np.add.reduceat(fed_grad.reshape(-1, 3 * h).take(order, axis=0), first, axis=0)
        return {"recur": before.reshape(-1, h).T @ moved_grad.reshape(-1, 3 * h), "rows": rows, "table": table}


def lay_out(lengths: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Deal texts to slots, longest first to the emptiest slot: slot and first step of each text, slots, steps."""
    total, longest = int(lengths.sum()), int(lengths.max())
    count = max(1, min(slots, -(-total // longest), len(lengths)))
    slot, first = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    loads = [(0, s) for s in range(count)]
    for i in np.argsort(-lengths, kind="stable").tolist():
        load, s = heapq.heappop(loads)
        slot[i], first[i] = s, load
        heapq.heappush(loads, (load + int(lengths[i]), s))
    return slot, first, count, max(loads)[0]


def grid(tokens: np.ndarray, lengths: np.ndarray):
    """Token, start and text matrices [steps, slots]; text is -1 where nothing stands."""
    slot, first, count, steps = lay_out(lengths)
    before = np.cumsum(lengths) - lengths
    at = np.repeat((first - before) * count + slot, lengths) + np.arange(0, len(tokens) * count, count)
    inputs, texts = np.zeros((steps, count), np.int64), np.full((steps, count), -1, np.int64)
    inputs.reshape(-1)[at], texts.reshape(-1)[at] = tokens, np.repeat(np.arange(len(lengths)), lengths)
    starts = texts < 0
    starts[first, slot] = True
    return inputs, starts, texts


def train(model: Model, tokens: np.ndarray, lengths: np.ndarray, squares: dict[str, np.ndarray]) -> None:
    """One pass of truncated backpropagation with per-weight step sizes."""
    inputs, starts, texts = grid(tokens, lengths)
    state, one = np.zeros((inputs.shape[1], model.hidden), np.float32), np.float32(1)
    for s in range(0, len(inputs), TRAIN_STEPS):
        x, b, live = inputs[s : s + TRAIN_STEPS], starts[s : s + TRAIN_STEPS], texts[s : s + TRAIN_STEPS].ravel() >= 0
        before, gates, carried, state = model.steps(state, x, b)
        count = np.count_nonzero(live)
        at = slice(None) if count == x.size else np.flatnonzero(live)
        _, grads = model.loss(before.reshape(-1, model.hidden)[at], x.ravel()[at], True)
        from_output = grads.pop("states")
        if count < x.size:
            from_output, some = np.zeros((x.size, model.hidden), np.float32), from_output
            from_output[at] = some
        deep = model.backward(x, b, before, gates, carried, from_output.reshape(before.shape))
        rows, scale = deep.pop("rows"), np.float32(1 / max(count, 1))
        for name, value in {**grads, **deep}.items():
            where = rows if name == "table" else slice(None)
            value *= scale
            np.maximum(value, -one, out=value)
            np.minimum(value, one, out=value)
            past = squares[name][where]
            past += value * value
            value *= np.float32(RATE)
            value /= np.sqrt(past + np.float32(1e-10))
            getattr(model, name)[where] -= value
            if name == "table":
                squares[name][where] = past


def score(model: Model, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of natural-log probabilities of each text, state carried from window to window."""
    inputs, starts, texts = grid(tokens, lengths)
    state = np.zeros((inputs.shape[1], model.hidden), np.float32)
    sums = np.zeros(len(lengths))
    for s in range(0, len(inputs), SCORE_STEPS):
        x, owner = inputs[s : s + SCORE_STEPS], texts[s : s + SCORE_STEPS].ravel()
        before, _, _, state = model.steps(state, x, starts[s : s + SCORE_STEPS])
        at = np.flatnonzero(owner >= 0)
        logp, _ = model.loss(before.reshape(-1, model.hidden)[at], x.ravel()[at], False)
        sums += np.bincount(owner[at], logp, len(sums))
    return sums


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts one after the other, and tokens per text, its end included."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = cut.flatten().cast(pa.binary())
    stops = np.asarray(cut.offsets).astype(np.int64)[1:] - cut.offsets[0].as_py()
    real = np.asarray(pc.binary_length(words)) > 0
    if not real.all():  # white space at either end leaves an empty string
        words = words.filter(pa.array(real))
        stops = np.concatenate([[0], np.cumsum(real)])[stops]
    return words, np.diff(stops, prepend=0) + 1


def with_ends(values: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """Values of the words of all texts with that of an end behind each text."""
    out = np.full(int(lengths.sum()), end, np.int64)
    words = np.ones(len(out), bool)
    words[np.cumsum(lengths) - 1] = False
    out[words] = values
    return out


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of all texts as places in an array of distinct ones, with an end each, and their number per text."""
    words, lengths = split_words(texts)
    words = words.dictionary_encode()
    places = with_ends(np.asarray(words.indices) + 1, lengths, 0)
    return places, lengths, pa.concat_arrays([pa.array([END], pa.binary()), words.dictionary])


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The same with the distinct words as a list."""
    places, lengths, distinct = coded(texts)
    return places, lengths, distinct.to_pylist()


def suffix_classes(words: pa.Array) -> np.ndarray:
    ends = pc.binary_slice(words, -2).dictionary_encode()
    classes = np.fromiter(map(suffix_class, ends.dictionary.to_pylist()), np.int64, len(ends.dictionary))
    return classes[np.asarray(ends.indices)]


def _model_ids(vocabulary: Vocabulary, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The model's number of each word, its own or that of its suffix class, and its place in the table or -1."""
    ranks = vocabulary.ranks(distinct)
    other = (ranks < 0) | (ranks >= vocabulary.own)
    ids = ranks.copy()
    ids[other] = SOFTMAX_WORDS + suffix_classes(distinct.filter(pa.array(other)))
    return ids, ranks


def training_ids(vocabulary: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The model's numbers of the tokens of all texts, and tokens per text."""
    words, lengths = split_words(texts)
    own = vocabulary.table[: vocabulary.own]
    ids = np.asarray(pc.index_in(words, value_set=own).fill_null(-1)).astype(np.int64)
    other = ids < 0
    ids[other] = SOFTMAX_WORDS + suffix_classes(words.filter(pa.array(other)))
    end = pc.index(own, pa.scalar(END, pa.binary())).as_py()
    return with_ends(ids, lengths, end if end >= 0 else SOFTMAX_WORDS + suffix_class(END)), lengths


def train_model(rows: DataFrame, vocabulary: Vocabulary) -> Model:
    """Train on all training texts and average. Weights come back in ``_PARTS`` added-up pieces."""

    def run(batches):
        model = Model(vocabulary)
        squares = {n: np.zeros_like(getattr(model, n)) for n in Model.NAMES}
        seen = 0
        for part in slices(batches, "text"):
            texts = training_texts(part)
            if len(texts):
                tokens, lengths = training_ids(vocabulary, texts)
                train(model, tokens, lengths, squares)
                seen += len(tokens)
        if seen:
            pieces = np.array_split(model.parameters() * np.float64(seen), _PARTS)
            cols = [pa.array(range(_PARTS), pa.int32()), pa.array([seen] * _PARTS, pa.int64()), pa.array([p.tobytes() for p in pieces], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["part", "seen", "data"])

    def add(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for part, seen, data in zip(*(batch.column(c).to_pylist() for c in ("part", "seen", "data"))):
                own = sums.setdefault(part, [0, 0.0])
                own[0] += seen
                own[1] = own[1] + np.frombuffer(data)
        for part, (seen, data) in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seen": [seen], "data": [data.tobytes()]})

    schema = "part int, seen long, data binary"
    added = rows.mapInArrow(run, schema).repartition(_PARTS, "part").mapInArrow(add, schema).collect()
    model = Model(vocabulary)
    if added:
        added.sort(key=lambda r: r["part"])
        model.load(np.concatenate([np.frombuffer(r["data"]) / r["seen"] for r in added]).astype(np.float32))
    return model


_SCHEMA = "kind string, row_id long, doc_id long, n_tokens long, n_known long, base double, score double, word binary, n long"
_NAMES = _SCHEMA.replace(",", "").split()[::2]


def _score_rows(model: Model):
    """Per text the sums over words in the table; per text and other word its count."""
    vocabulary = model.vocabulary
    smooth = math.log10(vocabulary.total + vocabulary.distinct + 1)

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text"):
            places, lengths, distinct = coded(part.column("text"))
            ids, rank = _model_ids(vocabulary, distinct)
            count = np.where(rank >= 0, vocabulary.counts[np.maximum(rank, 0)] if len(vocabulary.counts) else 0, 0)
            base = np.where(rank >= 0, np.log10(count + 1) - smooth, 0.0)
            listed = np.flatnonzero((rank >= 0) & (ids >= SOFTMAX_WORDS))
            inside = np.zeros(len(distinct))
            inside[listed] = vocabulary.shares(ids[listed] - SOFTMAX_WORDS, count[listed])
            text = np.repeat(np.arange(len(lengths)), lengths)
            size = len(lengths)
            total = score(model, ids[places], lengths) / math.log(10) + np.bincount(text, inside[places], size)
            known = np.bincount(text, rank[places] >= 0, size).astype(np.int64)
            rows = row + np.arange(size)
            row += size
            none = [pa.nulls(size, pa.binary()), pa.nulls(size, pa.int64())]
            cols = [pa.array(["text"] * size), pa.array(rows), part.column("doc_id"), pa.array(lengths), pa.array(known)]
            cols += [pa.array(np.bincount(text, base[places], size)), pa.array(total), *none]
            yield pa.RecordBatch.from_arrays(cols, _NAMES)
            other = rank[places] < 0
            pair, times = np.unique(text[other] * np.int64(len(distinct)) + places[other], return_counts=True)
            k = len(pair)
            words = distinct.take(pa.array(pair % len(distinct)))
            none = [pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            cols = [pa.array(["word"] * k), pa.array(rows[pair // len(distinct)]), *none, words, pa.array(times.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, _NAMES)

    return run


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = text_rows(docs, key, text)
    counts = stored(count_words(rows), "word-counts")
    vocabulary = learn_vocabulary(counts)
    model = train_model(rows, vocabulary)
    folder = shared_dir(spark, "scores")
    rows.mapInArrow(_score_rows(model), _SCHEMA).write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    both = spark.read.schema(_SCHEMA).parquet(folder)
    texts = both.where("kind = 'text'").select("row_id", "doc_id", "n_tokens", "n_known", "base", "score")
    words = both.where("kind = 'word'").select("row_id", "word", "n")

    c = F.coalesce(F.col("c"), F.lit(0))
    space = F.lit(float(vocabulary.total + vocabulary.distinct + 1))
    classes = F.array(*(F.lit(float(t + d + 1)) for t, d in zip(vocabulary.suffix_total.tolist(), vocabulary.suffix_distinct.tolist())))
    met = words.join(counts.select("word", F.col("n").alias("c")), "word", "left").select(
        "row_id",
        F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * F.log10((c + 1) / space)).alias("base"),
        (F.col("n") * F.log10((c + 1) / F.element_at(classes, _suffix("word") + 1))).alias("score"),
    )
    rest = met.groupBy("row_id").agg(*(F.sum(n).alias(f"more_{n}") for n in ("n_known", "base", "score")))
    plus = lambda n: (F.col(n) + F.coalesce(F.col(f"more_{n}"), F.lit(0)))
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return texts.join(rest, "row_id", "left").select(
        "doc_id",
        F.coalesce(crc == HELD_OUT, F.lit(True)).alias("held_out"),
        "n_tokens",
        plus("n_known").alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        plus("base").alias("base_score"),
        plus("score").alias("score"),
    )

"""Language identification by error-correcting output codes over byte n-grams.

Every learned language has a codeword. One binary classifier per bit tells the languages with a one
there from those with a zero, from hashed byte n-grams of the folded text: its weight for an
n-gram is the logarithm of the n-gram's share in the one group over that in the other, all
languages of a group counting alike. A text's margin for a bit is the mean weight of its n-grams,
in units of the bit's usual margin. Decoding sums, over the bits, the exponential loss of the
margin against a codeword's bit, each bit weighing by how rarely it was wrong on the training rows; the
nearest codeword (least loss) names the language. The score is the share of the nearest codeword
in exp(-loss) over all codewords. A text whose nearest two codewords are too close is flagged.

Training counts every n-gram of every training text; no row is sampled, and counts are whole numbers,
so the model does not depend on the layout of the input. Few languages get every way to split them in two;
more get ``code_bits(k)`` columns, drawn by a fixed rule to keep codewords apart. The driver sees
the list of languages and the weights, bits x ``BUCKETS`` numbers.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and not ambiguous; so is
every text when nothing was learned. With one learned language every other text is that one, with score 1.
Languages of equal loss go by name. Rows without an id take part like others and are training rows,
as are rows of ids that repeat (each by itself); a null language teaches nothing. Empty tables give
no row. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.llm.common import slices
from stepwise.session import stored

#: Lengths of the n-grams in bytes, and the places that their hashes have.
GRAMS = (2, 3, 4)
BUCKETS = 1 << 16
#: Up to so many languages all splits in two are bits.
ALL_SPLITS = 6
#: Added to every count, so that unseen n-grams weigh little.
SMOOTH = 0.5
#: Text bytes of a slice, bytes whose n-grams are made at once, numbers that are looked up at once.
SLICE, PIECE, LOOKUPS = 4 << 20, 1 << 20, 1 << 21
#: Languages whose counts a task holds at once, ``BUCKETS`` numbers each.
HELD = 64
#: Below this score a text is ambiguous.
SURE = 0.9
UNKNOWN = "und"

#: Letters in lower case and bytes above 127 stay, all else is a blank.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)], np.uint8)


def code_bits(languages: int) -> int:
    """Bits of a codeword: all splits of few languages, else ten per doubling of their number."""
    if languages <= ALL_SPLITS:
        return max(0, 2 ** (languages - 1) - 1)
    return math.ceil(10 * math.log2(languages))


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 per language. No column is constant, none repeats or mirrors another.

    Above ``ALL_SPLITS`` languages there are more even splits than bits, so that the draw ends.
    """
    bits = code_bits(languages)
    if languages <= ALL_SPLITS:
        columns = [c for c in itertools.product((1, -1), repeat=languages) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).reshape(bits, languages).T
    best, widest = None, -1
    for seed in range(20):  # of twenty drawn codes, the one whose nearest codewords are farthest apart
        draw = np.random.Generator(np.random.PCG64(seed))
        chosen: dict[bytes, np.ndarray] = {}
        while len(chosen) < bits:
            column = np.where(draw.permutation(languages) < languages // 2, 1, -1).astype(np.int8)
            chosen.setdefault((column * column[0]).tobytes(), column)
        code = np.stack(list(chosen.values()), axis=1)
        apart = (bits - code.astype(np.int32) @ code.T) // 2
        np.fill_diagonal(apart, bits)
        if (least := int(apart.min())) > widest:
            best, widest = code, least
    return best


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash place) of all n-grams, piece by piece; text numbers ascend within a piece."""
    blank, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    spaced = pc.binary_join_element_wise(blank, texts.cast(pa.large_string()), blank, nothing)
    if not len(spaced):
        return
    offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    folded = _FOLD[np.frombuffer(spaced.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    first = offsets[:-1] - offsets[0]
    keep = np.ones(len(folded), bool)  # one blank for a run of them, within a text
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    keep[first] = True
    at = np.concatenate([[0], np.cumsum(np.add.reduceat(keep, first, dtype=np.int64))])
    folded = folded[keep]
    for a in range(0, len(folded), PIECE):
        part = folded[a : a + PIECE + max(GRAMS) - 1].astype(np.uint32)
        starts = min(PIECE, len(folded) - a)
        low, high = np.searchsorted(at, [a, a + starts - 1], "right") - 1
        edges = np.clip(at[low : high + 2], a, a + starts)
        owner = np.repeat(np.arange(low, high + 1), np.diff(edges))
        left = at[owner + 1] - np.arange(a, a + starts)  # bytes from a place to the end of its text
        key = np.zeros(starts, np.uint32)
        for n in range(1, max(GRAMS) + 1):
            reach = min(starts, len(part) - n + 1)
            if reach <= 0:
                break
            key[:reach] |= part[n - 1 : n - 1 + reach] << np.uint32(8 * (n - 1))
            if n in GRAMS:
                whole = np.flatnonzero(left[:reach] >= n)
                mixed = (key[whole] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(15)
                yield owner[whole], ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(16)) & np.uint32(BUCKETS - 1)


def train_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2, and the language is known."""
    return docs.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")


def prepared(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, text (null read as empty), lang, held_out, and whether there is a letter."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.col(lang).cast("string").alias("lang"),
        F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, bucket, n over all training rows. A task adds up its own, for ``HELD`` languages at a time."""

    def emit(held: dict[str, np.ndarray]):
        for name, n in held.items():
            bucket = np.flatnonzero(n)
            langs = pa.DictionaryArray.from_arrays(np.zeros(len(bucket), np.int32), [name]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([langs, pa.array(bucket.astype(np.int32)), pa.array(n[bucket])], ["lang", "bucket", "n"])

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for part in slices(batches, "text", SLICE):
            coded = part.column("lang").dictionary_encode()
            names, own = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            for text, places in grams(part.column("text")):
                kinds = own[text]
                for i in np.unique(kinds).tolist():
                    if names[i] not in held and len(held) >= HELD:
                        yield from emit(held)
                        held = {}
                    held.setdefault(names[i], np.zeros(BUCKETS, np.int64))
                    held[names[i]] += np.bincount(places[kinds == i], minlength=BUCKETS)
        yield from emit(held)

    return rows.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # BUCKETS x bits
    scale: np.ndarray  # a bit's usual margin
    trust: np.ndarray  # a bit's weight in decoding

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Mean weight of the texts' n-grams per bit; 0 for a text without any."""
        bits = self.weights.shape[1]
        out, counts = np.zeros((len(texts), bits)), np.zeros(len(texts), np.int64)
        step = max(1, LOOKUPS // max(bits, 1))
        for text, places in grams(texts):
            for a in range(0, len(text), step):
                own = text[a : a + step]
                first = np.flatnonzero(np.diff(own, prepend=-1))
                out[own[first]] += np.add.reduceat(self.weights[places[a : a + step]], first, axis=0)
                counts[own[first]] += np.diff(np.append(first, len(own)))
        return out / np.maximum(counts, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score, number of the second language (its own where there is no other)."""
        scaled = np.clip(margins / self.scale, -20, 20)
        loss = np.zeros((len(margins), len(self.languages)))
        for bit in range(self.code.shape[1]):
            loss += self.trust[bit] * np.exp(-scaled[:, bit : bit + 1] * self.code[:, bit])
        order = np.argsort(loss, axis=1, kind="stable")
        first, second = order[:, 0], order[:, min(1, len(self.languages) - 1)]
        rows = np.arange(len(loss))
        share = np.exp(loss[rows, first][:, None] - loss).sum(axis=1)
        return first, 1 / share, second


def _weights(counts: DataFrame, languages: list[str], code: np.ndarray) -> np.ndarray:
    """BUCKETS x bits. A language's smoothed share of an n-gram, averaged over each side of the bit."""
    sums = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = np.array([sums.get(name, 0) for name in languages], np.float64) + SMOOTH * BUCKETS
    bits = code.shape[1]
    positive = (code > 0).astype(np.float64)
    ones, zeros = positive / positive.sum(axis=0), (1 - positive) / (1 - positive).sum(axis=0)
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            langs = [number[x] for x in batch.column("lang").to_pylist()]
            bucket, n = (np.asarray(batch.column(c)) for c in ("bucket", "n"))
            for i, b, c in zip(langs, bucket.tolist(), n.tolist()):
                held.setdefault(b, np.zeros(len(languages)))[i] = c
        if held:
            share = (np.stack(list(held.values())) + SMOOTH) / total
            ratio = np.log(share @ ones) - np.log(share @ zeros)
            rows = [pa.array(np.fromiter(held, np.int32)), pa.array([r.astype("<f4").tobytes() for r in ratio])]
            yield pa.RecordBatch.from_arrays(rows, ["bucket", "weights"])

    unseen = SMOOTH / total
    weights = np.tile((np.log(unseen @ ones) - np.log(unseen @ zeros)).astype(np.float32), (BUCKETS, 1))
    for row in counts.repartition("bucket").mapInArrow(run, "bucket int, weights binary").collect():
        weights[row["bucket"]] = np.frombuffer(row["weights"], "<f4", bits)
    return weights


def learn(rows: DataFrame) -> Model | None:
    """The model of ``prepared`` rows, or None when there is nothing to learn from."""
    known = train_rows(rows)
    counts = stored(count_grams(known), "langid-counts")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    code = codewords(len(languages))
    bits = code.shape[1]
    model = Model(languages, code, np.zeros((BUCKETS, 0), np.float32), np.ones(bits), np.ones(bits))
    if not bits:
        return model
    model.weights = _weights(counts, languages, code)
    shipped = rows.sparkSession.sparkContext.broadcast((model.weights, {name: i for i, name in enumerate(languages)}))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights, number = shipped.value
        margins = Model(languages, code, weights, np.ones(bits), np.ones(bits)).margins(batch.column("text"))
        own = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()])
        margins, own = margins[own >= 0], own[own >= 0]
        towards = margins * code[own]
        # Whole numbers add up alike in any order.
        cols = [np.arange(bits), (towards <= 0).sum(axis=0), np.full(bits, len(own)), np.rint(np.abs(margins) * (1 << 20)).astype(np.int64).sum(axis=0)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["bit", "wrong", "seen", "size"])

    def run(batches):
        for part in slices(batches, "text", SLICE):
            yield judge(part)

    seen = known.where("has_letter").select("lang", "text").mapInArrow(run, "bit long, wrong long, seen long, size long")
    for row in seen.groupBy("bit").agg(*(F.sum(c).alias(c) for c in ("wrong", "seen", "size"))).collect():
        error = (row["wrong"] + 1) / (row["seen"] + 2)
        model.scale[row["bit"]] = max(row["size"] / max(row["seen"], 1) / (1 << 20), 1e-6)
        model.trust[row["bit"]] = max(math.log((1 - error) / error), 0.01)
    model.trust *= bits / model.trust.sum()
    return model


def predict_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, second (next language), ambiguous."""
    rows = prepared(docs, key, text, lang)
    model = learn(rows)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, letters = shipped.value, np.asarray(batch.column("has_letter"))
        if model is None:
            letters = np.zeros(batch.num_rows, bool)
            names, score, second = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows), np.full(batch.num_rows, None)
        else:
            first, score, other = model.decode(model.margins(batch.column("text")))
            known = np.array(model.languages, object)
            names, second = np.where(letters, known[first], UNKNOWN), np.where(letters & (other != first), known[other], None)
        score = np.where(letters, np.round(score, 6), 0.0)
        cols = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(second, pa.string())]
        return pa.RecordBatch.from_arrays([*cols, pa.array(letters & (score < SURE))], ["doc_id", "held_out", "lang_pred", "score", "second", "ambiguous"])

    schema = "doc_id long, held_out boolean, lang_pred string, score double, second string, ambiguous boolean"

    def run(batches):
        for part in slices(batches, "text", SLICE):
            yield predict(part)

    return rows.select("doc_id", "text", "held_out", "has_letter").mapInArrow(run, schema)

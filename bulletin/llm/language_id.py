"""Language identification by interpolated Kneser-Ney character models, one per language.

Text is lower-cased; runs of anything but letters become one space. Training counts every
character 4-gram of every training document, summed per task and then per key, so counts
cover the corpus while each task sends its distinct grams only. No gram is dropped. The
model of a language is a pair of sorted hash arrays per order (discounted probabilities of
grams, back-off weights of contexts). It is written to the shared folder in parts, by a hash
of the two middle characters, so that a gram, its suffixes down to two characters and all
their contexts lie in one part; tables of one and two characters go with every part. A
worker holds a few parts at a time and looks a gram up once, whatever the number of parts;
the driver gets the names of the languages only. A document gets the language of the lowest cross-entropy per
character. It is rejected when that entropy is nearer to what the language's characters
would show in random order than to what its training documents show as written, with a
margin of `z` standard deviations for short texts. Both are exact, over all training
documents: the first is the mean over every counted gram; the second is the expectation
over characters drawn by their frequency (a space never follows a space), a sum over the
grams and contexts of the model, since all others fall back to shorter ones.

Null or letterless text gives `und`, score 0 and is rejected; with no training row at all,
every text does. Null languages are not learned. Ties go to the first language in code
point order. Columns that clash with the results' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import fresh_path, settle

ORDER = 4
SPACE = 32
#: Characters beyond this code point share it, so that four fit 64 bits.
TOP = 0xFFFF
RESULTS = ("lang_pred", "score", "rejected", "cross_entropy")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_letters: np.ndarray | None = None


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def hashed(grams: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit keys."""
    h = grams * _MIX
    return h ^ (h >> np.uint64(32))


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def gram_keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The packed grams that end at each character of each text, and the number of them per text.

    A text starts after ORDER - 1 zeros, so that no gram crosses texts.
    """
    pad = "\0" * (ORDER - 1)
    low = [(t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    points = np.frombuffer((pad + pad.join(low)).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner_start = np.cumsum(sizes + len(pad)) - sizes
    own = np.ones(len(points), bool)
    for k in range(len(pad)):
        own[owner_start - 1 - k] = False
    alpha = letters()[points]
    chars = np.where(alpha, np.minimum(points, TOP), SPACE).astype(np.uint64)
    chars[~own] = 0
    first = np.zeros(len(points), bool)
    first[owner_start[sizes > 0]] = True
    gap = own & ~alpha
    # One space per gap, none at the start of a text.
    keep = ~gap
    keep[1:] |= gap[1:] & alpha[:-1]
    keep &= ~(gap & first)
    chars, own = chars[keep], own[keep]
    if len(chars) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    key = chars[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        key |= chars[ORDER - 1 - k : len(chars) - k] << np.uint64(16 * k)
    ends = own[ORDER - 1 :]
    text_of = np.cumsum(first)[keep][ORDER - 1 :][ends]  # 1-based among non-empty texts
    counts = np.zeros(len(texts), np.int64)
    counts[sizes > 0] = np.bincount(text_of, minlength=int((sizes > 0).sum()) + 1)[1:]
    return key[ends], counts


class GramIndex:
    """Small dense numbers for 64-bit keys; forgets everything once `limit` keys are known."""

    def __init__(self, limit: int = 1 << 20) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys = self.sorted = np.zeros(0, np.uint64)
        self.order = np.zeros(0, np.int64)
        self.slot_key = np.zeros(1 << 20, np.uint64)
        self.slot_id = np.full(1 << 20, -1, np.int32)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        slot = hashed(keys) >> np.uint64(44)
        ids = np.where(self.slot_key[slot] == keys, self.slot_id[slot], -1)
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            uniq, inverse = np.unique(keys[lost], return_inverse=True)
            at = np.searchsorted(self.sorted, uniq)
            known = np.zeros(len(uniq), bool)
            inside = at < len(self.keys)
            known[inside] = self.sorted[at[inside]] == uniq[inside]
            number = np.empty(len(uniq), np.int32)
            number[known] = self.order[at[known]]
            if not known.all():
                number[~known] = len(self.keys) + np.arange((~known).sum())
                self.keys = np.concatenate([self.keys, uniq[~known]])
                self.order = np.argsort(self.keys, kind="stable")
                self.sorted = self.keys[self.order]
            ids[lost] = number[inverse]
            where = hashed(uniq) >> np.uint64(44)
            free = self.slot_id[where] < 0
            self.slot_key[where[free]], self.slot_id[where[free]] = uniq[free], number[free]
        return ids


def chunks(texts: list, weight: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of `texts` of about `weight` characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= weight:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, totals = GramIndex(), {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(index.keys[at].view(np.int64)), pa.array(counts[at])], ["lang", "gram", "n"]
            )
        totals.clear()
        index.clear()

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        order = sorted(range(len(langs)), key=langs.__getitem__)
        langs, texts = [langs[i] for i in order], [texts[i] for i in order]
        for lang in dict.fromkeys(langs):
            a, b = langs.index(lang), len(langs) - langs[::-1].index(lang)
            for lo, hi in chunks(texts[a:b]):
                keys, _ = gram_keys(texts[a + lo : a + hi])
                rows = index.rows(keys)
                new = np.bincount(rows, minlength=len(index.keys))
                old = totals.get(lang, np.zeros(0, np.int64))
                new[: len(old)] += old
                totals[lang] = new
                if len(index.keys) > index.limit:
                    yield from flush()
    yield from flush()


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram, by its two middle characters; the same as `part_column`."""
    middle = (grams >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
    return ((middle >> np.uint64(16)) * np.uint64(40_503) + (middle & np.uint64(0xFFFF)) * np.uint64(69_069)) % np.uint64(1_000_003) % np.uint64(parts)


def part_column(gram: Column, parts: int) -> Column:
    code = lambda at: F.shiftrightunsigned(gram, at).bitwiseAND(F.lit(0xFFFF).cast("long"))
    return (code(32) * 40_503 + code(16) * 69_069) % 1_000_003 % parts


#: gram hashes, discounted probabilities, context hashes, back-off weights
Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Model:
    """Where the parts of the model lie, and the calibration of the rejection."""

    langs: list[str]
    folder: str = ""
    parts: int = 1
    #: per language: the entropy beyond which long texts are rejected, and the variance of one character
    usual: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    z: float = 3.0

    def log_probs(self, grams: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of the last character of each gram, per language."""
        out = np.empty((len(grams), len(self.langs)), np.float32)
        low, floor = low_tables(self.folder, len(self.langs))
        part = part_of(grams, self.parts)
        for r in np.unique(part).tolist():
            at = np.flatnonzero(part == r)
            high = high_tables(self.folder, r, len(self.langs))
            for j in range(len(self.langs)):
                out[at, j] = np.log(_interpolated([*low[j], *high[j]], floor[j], grams[at], ORDER))
        return out

    def index(self) -> GramIndex:
        """As many known grams as make 32 MB of probabilities, 65,536 at least."""
        return GramIndex(max(1 << 16, (1 << 23) // max(len(self.langs), 1)))


def _read(folder: str) -> pa.Table:
    store, path = fs.FileSystem.from_uri(folder)
    names = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
    columns = ["lang", "gram", "n"]
    return pa.concat_tables([pq.read_table(n, columns=columns, filesystem=store, partitioning=None) for n in sorted(names)]) if names else pa.table({c: pa.array([], pa.int64()) for c in columns})


def _by_language(folder: str, langs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    table = _read(folder)
    lang, gram, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
    order = np.argsort(lang, kind="stable")
    ends = np.searchsorted(lang[order], np.arange(langs + 1))
    for a, b in zip(ends, ends[1:]):
        yield gram[order[a:b]].view(np.uint64), n[order[a:b]]


@lru_cache(maxsize=1)
def low_tables(folder: str, langs: int) -> tuple[list[list[Table]], list[float]]:
    """Per language the tables of one and two characters, and the probability of an unknown character."""
    tables, floor = [], []
    for keys, n in _by_language(f"{folder}/low", langs):
        ones, count = np.unique(keys & np.uint64(0xFFFF), return_counts=True)
        tables.append([discounted(ones, count), discounted(keys, n)])
        floor.append(1.0 / (len(ones) + 1))
    return tables, floor


@lru_cache(maxsize=4)
def high_tables(folder: str, part: int, langs: int) -> list[list[Table]]:
    """Per language the tables of three and four characters of one part."""
    tables = []
    for keys, n in _by_language(f"{folder}/high/part={part}", langs):
        # A lower gram counts once per distinct character before it.
        threes, count = np.unique(keys & np.uint64((1 << 48) - 1), return_counts=True)
        tables.append([discounted(threes, count), discounted(keys, n)])
    return tables


def discounted(keys: np.ndarray, n: np.ndarray, discount: float = 0.75) -> Table:
    contexts, at = np.unique(keys >> np.uint64(16), return_inverse=True)
    total = np.bincount(at, weights=n)
    value = np.maximum(n - discount, 0) / total[at]
    weight = discount * np.bincount(at) / total
    a, b = np.argsort(hashed(keys)), np.argsort(hashed(contexts))
    return hashed(keys)[a], value[a], hashed(contexts)[b], weight[b]


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _score(model: Model, texts: list[str | None], index: GramIndex, memo: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed log-probabilities (texts x languages), of squares, and characters per text."""
    sums = np.zeros((len(texts), len(model.langs)))
    squares = np.zeros_like(sums)
    sizes = np.zeros(len(texts), np.int64)
    for lo, hi in chunks(texts):
        if len(index.keys) > index.limit:
            index.clear()
            memo.clear()
        keys, n = gram_keys(texts[lo:hi])
        rows = index.rows(keys)
        known = memo.get("p", np.zeros((0, len(model.langs)), np.float32))
        if len(index.keys) > len(known):
            known = memo["p"] = np.concatenate([known, model.log_probs(index.keys[len(known) :])])
        sizes[lo:hi] = n
        full = np.flatnonzero(n)
        if len(full):
            starts = (np.cumsum(n) - n)[full]
            for j in range(len(model.langs)):
                p = known[:, j][rows]
                sums[lo + full, j] = np.add.reduceat(p, starts, dtype=np.float64)
                squares[lo + full, j] = np.add.reduceat(p * p, starts, dtype=np.float64)
    return sums, squares, sizes


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
    part_grams: int = 1_000_000, z: float = 3.0,
) -> Model:
    """Learn from the rows of `docs` that have a language and a text.

    The model has one part per `part_grams` grams (about 50 bytes each), of which a worker
    holds four and reads others when it meets a gram for the first time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    counted = rows.mapInArrow(_count_grams, "lang string, gram long, n long")
    grams = settle(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    langs = sorted((r[0] for r in grams.select("lang").distinct().collect()), key=lambda x: x.encode("utf-8"))
    model = Model(langs, fresh_path(spark, "language-model"), max(1, -(-grams.count() // part_grams)), z=z)
    if langs:
        number = F.array_position(F.lit(langs), F.col("lang")).cast("long") - 1
        grams = grams.select(number.alias("lang"), "gram", "n", part_column(F.col("gram"), model.parts).cast("int").alias("part"))
        grams.repartitionById(model.parts, "part").write.partitionBy("part").parquet(f"{model.folder}/high")
        last = lambda chars: F.col("gram").bitwiseAND(F.lit((1 << 16 * chars) - 1).cast("long")).alias("gram")
        low = grams.select("lang", last(3)).distinct().groupBy("lang", last(2)).agg(F.count("*").alias("n"))
        low.write.parquet(f"{model.folder}/low")
        grams.groupBy("lang", last(1)).agg(F.sum("n").alias("n")).write.parquet(f"{model.folder}/ones")
        shared = spark.sparkContext.broadcast(model)
        # One task per part: sums over its grams, which are whole whatever their number.
        sums = spark.range(0, model.parts, 1, model.parts).mapInArrow(_calibrate(shared), "lang long, n double, said double, squares double, loose double")
        found = sums.groupBy("lang").agg(*[F.sum(c).alias(c) for c in ("n", "said", "squares", "loose")]).orderBy("lang").collect()
        mean = np.array([r["said"] / r["n"] for r in found])
        model.usual = np.column_stack([(mean + [r["loose"] for r in found]) / 2, [max(r["squares"] / r["n"] - m**2, 0) for r, m in zip(found, mean)]])
    return model


def _random_order(folder: str, langs: int) -> Iterator[np.ndarray]:
    """Per language the probabilities of every character in random order: after a letter, anywhere, after a space."""
    for chars, n in _by_language(f"{folder}/ones", langs):
        after = np.zeros((3, 1 << 16))
        after[0, chars] = n / n.sum()
        spaces = after[0, SPACE]
        after[2] = after[0] / (1 - spaces)
        after[2, SPACE] = 0
        after[1] = after[2] / (1 + spaces)
        after[1, SPACE] = spaces / (1 + spaces)
        yield after


def _drawn(after: np.ndarray, grams: np.ndarray, size: int) -> np.ndarray:
    """Probability of each string of `size` characters where characters come in random order."""
    out, before = np.ones(len(grams)), None
    for k in range(size)[::-1]:
        char = ((grams >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)
        out *= after[1, char] if before is None else np.where(before == SPACE, after[2, char], after[0, char])
        before = char
    return out


def _calibrate(shared):
    """Per part and language: sums over the counted grams as written, and the part's share of the expectation in random order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        langs = len(model.langs)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                low, floor = low_tables(model.folder, langs)
                high = high_tables(model.folder, part, langs)
                counted = zip(*(_by_language(f"{model.folder}/{x}", langs) for x in (f"high/part={part}", "low")), _random_order(model.folder, langs))
                sums = []
                for j, ((grams, n), (short, _), after) in enumerate(counted):
                    tables = [*low[j], *high[j]]
                    log_p = np.log(_interpolated(tables, floor[j], grams, ORDER))
                    loose = _loose(tables, floor[j], grams, after, ORDER)
                    # The short grams go with every part and count in the first.
                    if part == 0:
                        loose += _loose(tables, floor[j], short, after, 2) - np.log(floor[j])
                    sums.append((j, float(n.sum()), -(n * log_p).sum(), (n * log_p**2).sum(), loose))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*sums), [pa.int64(), *[pa.float64()] * 4])], ["lang", "n", "said", "squares", "loose"]
                )

    return run


def _interpolated(tables: list[Table], floor: float, grams: np.ndarray, size: int) -> np.ndarray:
    """Probability of the last character of each string of `size` characters."""
    p = np.full(len(grams), floor)
    for k, (keys, value, contexts, weight) in enumerate(tables[:size], 1):
        own = grams & np.uint64((1 << 16 * k) - 1)
        p = _find(keys, value, hashed(own), 0.0) + _find(contexts, weight, hashed(own >> np.uint64(16)), 1.0) * p
    return p


def _loose(tables: list[Table], floor: float, grams: np.ndarray, after: np.ndarray, size: int) -> float:
    """What grams of `size` and one fewer characters add to the expected entropy beyond that of shorter ones.

    An unseen gram has its suffix's probability times the weight of its context, or that
    probability itself if its context is unseen too, so only seen grams and contexts add.
    """
    total = 0.0
    for k in (size - 1, size):
        seen = np.unique(grams & np.uint64((1 << 16 * k) - 1))
        contexts = np.unique(seen >> np.uint64(16))
        weight = lambda c: np.log(_find(tables[k - 1][2], tables[k - 1][3], hashed(c), 1.0))  # noqa: E731, B023
        total -= (_drawn(after, contexts, k - 1) * weight(contexts)).sum()
        unseen = weight(seen >> np.uint64(16)) + np.log(_interpolated(tables, floor, seen, k - 1))
        total += (_drawn(after, seen, k) * (unseen - np.log(_interpolated(tables, floor, seen, k)))).sum()
    return total


def _predict(model: Model, texts: list[str | None], index: GramIndex, memo: dict) -> pd.DataFrame:
    n = len(texts)
    letter = np.fromiter((_has_letter(t) for t in texts), bool, n)
    if not model.langs:
        return pd.DataFrame({"lang_pred": ["und"] * n, "score": 0.0, "rejected": True, "cross_entropy": np.full(n, np.nan)})
    sums, _, sizes = _score(model, texts, index, memo)
    entropy = -sums / np.maximum(sizes, 1)[:, None]
    best = entropy.argmin(axis=1)
    low = entropy[np.arange(n), best]
    # Evidence is taken for at most 32 characters, as neighbouring characters are not independent.
    share = 1 / np.exp(-(entropy - low[:, None]) * np.minimum(sizes, 32)[:, None]).sum(axis=1)
    limit, inside = model.usual[best].T
    far = low > limit + model.z * np.sqrt(inside / np.maximum(sizes, 1))
    names = np.array(model.langs, dtype=object)[best]
    names[~letter] = "und"
    return pd.DataFrame(
        {"lang_pred": names, "score": np.where(letter, share, 0.0), "rejected": ~letter | far, "cross_entropy": np.where(letter, low, np.nan)}
    )


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add `lang_pred, score, rejected, cross_entropy` (nats per character) to `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean, cross_entropy double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index, memo = shared.value.index(), {}
        for texts in parts:
            yield _predict(shared.value, texts.tolist(), index, memo)

    kept = [c for c in docs.columns if c not in RESULTS]
    out = docs.withColumn("_said", predict(F.col(text_col)))
    return out.select(*kept, *[F.col(f"_said.{c}").alias(c) for c in RESULTS])

"""Secret scan: fixed patterns, and character Markov models that tell random strings from identifiers.

Two first-order models over 67 characters are counted from labelled samples. Runs of such
characters lose what the spans of the fixed patterns cover; in each piece that is left, the
stretches whose log-likelihood ratio of random against ordinary is largest are reported, so
that a name or a path glued to a value does not hide it. Everything is built-in functions
inside the row: the spans of a pattern follow from the lengths of its matches and of the
pieces between them.

Null texts are empty; positions are code points, ends exclusive. Rows are kept one by one,
so repeated and null ids need no rule. Only id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import let

#: Kinds in their order among spans of one start: pattern, group whose length counts, least length.
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]+", 0, 32),
}
#: Runs that fail a least length are matched in a form that skips them at once, where that cannot move later matches.
FAST = {"hex": r"(?<![0-9a-f])[0-9a-f]{32,}"}
LEARNED = "random"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = "A-Za-z0-9+/_=-"
#: Prefix sums are built in blocks, as appending to an array copies it.
BLOCK = 256


def before(lengths: Column) -> Column:
    """Exclusive prefix sums of an array of integers."""
    return let(lengths, _before)


def _before(lengths: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))

    def scan(values: Column, start: Column) -> Column:
        empty = F.struct(start.cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out"))
        step = lambda s, v: F.struct((s["sum"] + v).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out"))
        return F.aggregate(values, empty, step, lambda s: s["out"])

    def join(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, v: a + v))
        return let(scan(totals, F.lit(0)), lambda at: F.flatten(F.transform(parts, lambda p, i: scan(p, F.get(at, i)))))

    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, join))


def pattern_spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """`start, end, value` of the matches of `pattern` whose `group` has `least` characters or more."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def place(found: Column) -> Column:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        # A lambda's body is evaluated for every element, so the text is matched outside of them.
        parts = F.struct(F.split(text, pattern, -1).alias("pieces"), values.alias("values"))
        return F.when(F.size(found) == 0, none).otherwise(let(parts, lambda p: spans(found, p["pieces"], p["values"])))

    def spans(found: Column, pieces: Column, values: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.char_length(F.get(pieces, i)) + F.char_length(m))

        def build(ends_before: Column) -> Column:
            at = lambda m, i: F.get(ends_before, i) + F.char_length(F.get(pieces, i))
            span = lambda m, i: F.struct(at(m, i).alias("start"), (at(m, i) + F.char_length(m)).alias("end"), F.get(values, i).alias("value"))
            return F.filter(F.transform(found, span), lambda s: F.char_length(s["value"]) >= least)

        return let(before(steps), build)

    return let(matches, place)


def base_spans(text: Column) -> dict[str, Column]:
    return {kind: pattern_spans(text, FAST.get(kind, pattern), group, least) for kind, (pattern, group, least) in BASE.items()}


def symbols(text: Column) -> Column:
    """Positions of the characters in ALPHABET, 1-based; the text is cut into characters once, whatever its length."""
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def default_samples(docs: DataFrame, sample_docs: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled samples `text, random` from at most `sample_docs` documents, chosen by a hash of their ids.

    Random: the values of their fixed patterns, and digests of their ids in hexadecimal and
    base 64. Ordinary: their numbers and words, and words joined with each other and with
    numbers as in identifiers, constants and paths.
    """
    chosen = docs.select(F.col(id_col).cast("string").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    # A cut on the lot first, so that a task hands on few of its rows whatever their number.
    lots = 1_000_003
    share = min(1.0, 8 * sample_docs / max(docs.count(), 1))
    chosen = chosen.withColumn("_lot", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(lots))).filter(F.col("_lot") <= share * lots)
    chosen = chosen.orderBy("_lot", "_id", F.xxhash64("_t")).limit(sample_docs)
    digest = F.sha2(F.coalesce("_id", F.lit("")), 256)
    values = F.flatten(F.array(*[F.transform(s, lambda x: x["value"]) for s in base_spans(F.col("_t")).values()]))
    longer = F.sha2(F.concat(F.lit("x"), F.coalesce("_id", F.lit(""))), 512)
    packed = [F.regexp_replace(F.base64(F.unhex(d)), r"\s", "") for d in (digest, longer)]
    made = F.concat(values, F.array(digest, *packed))
    words = F.filter(F.regexp_extract_all("_t", F.lit("[A-Za-z]+"), F.lit(0)), lambda w: F.char_length(w).between(2, 19))
    numbers = F.regexp_extract_all("_t", F.lit(f"(?<![{RUN}])[0-9][0-9/_-]+(?![{RUN}])"), F.lit(0))
    glue = F.array(*[F.lit(c) for c in "_-/=+"], F.lit(""))

    def form(ws: Column, w: Column, i: Column) -> Column:
        """A word as it is or as part of a name; its position picks the form, so that each is drawn from all words."""
        turn, other, number = i % 5, F.coalesce(F.get(ws, i + 1), F.lit("")), (F.abs(F.xxhash64(w, i)) % 1000).cast("string")
        joint = F.get(glue, (F.floor(i / 5) % 6).cast("int"))
        forms = F.when(turn == 0, F.concat(w, joint, other)).when(turn == 1, F.concat(w, F.initcap(other))).when(turn == 2, F.concat(w, joint, number))
        return forms.when(turn == 3, F.upper(F.concat(w, F.lit("_"), other))).otherwise(w)

    ordinary = let(words, lambda ws: F.transform(ws, lambda w, i: form(ws, w, i)))
    ordinary = F.concat(numbers, ordinary)
    return chosen.select(F.explode(made).alias("text"), F.lit(True).alias("random")).unionByName(
        chosen.select(F.explode(ordinary).alias("text"), F.lit(False).alias("random"))
    )


def train(samples: DataFrame, weight: float = 10.0, floor: float = 0.01) -> list[float]:
    """Log-likelihood ratios of all transitions, row by row; characters outside ALPHABET are skipped.

    A transition's probability leans on how often its second character occurs at all, as
    `weight` observations; of that, `floor` is spread evenly, so that a character which
    neither class knows speaks for neither. `samples` has `text` and `random`; null texts
    and labels are left out. The driver gets the counts of two tables of fixed size.
    """
    n = len(ALPHABET)
    rows = samples.filter("text is not null and random is not null and char_length(text) > 1")
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.char_length("text") - 1), lambda i: F.substring("text", i, F.lit(2))))
    counted = rows.select("random", pair.alias("pair")).filter(F.col("pair").rlike(f"^[{RUN}]{{2}}$")).groupBy("random", "pair").count()
    tables = {random: [[0.0] * n for _ in range(n)] for random in (True, False)}
    for random, pair, count in counted.collect():
        tables[random][ALPHABET.index(pair[0])][ALPHABET.index(pair[1])] += count

    def probabilities(table: list[list[float]]) -> list[float]:
        seen = [sum(row[b] for row in table) for b in range(n)]
        total = sum(seen)
        own = [(1 - floor) * (x / total if total else 1 / n) + floor / n for x in seen]
        return [(row[b] + weight * own[b]) / (sum(row) + weight) for row in table for b in range(n)]

    return [math.log(x / y) for x, y in zip(probabilities(tables[True]), probabilities(tables[False]), strict=True)]


def transitions(text: Column, model: list[float]) -> Column:
    """Nats in favour of a random string, of every two neighbours in a text over ALPHABET."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    n = len(ALPHABET)
    pair = lambda codes, i: F.get(table, (F.get(codes, i - 1) - 1) * n + F.get(codes, i) - 1)
    none = F.array().cast("array<double>")
    return let(symbols(text), lambda c: F.when(F.size(c) < 2, none).otherwise(F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: pair(c, i))))


def ratio_of(text: Column, model: list[float]) -> Column:
    """Nats per transition in favour of a random string, over a whole text."""
    total = lambda steps: F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)
    return let(transitions(text, model), lambda s: F.when(F.size(s) == 0, F.lit(0.0)).otherwise(total(s) / F.size(s)))


def stretches(steps: Column, least: int, evidence: float, drop: float) -> Column:
    """`first, last, nats` of the stretches of `least` characters or more whose transitions sum to `evidence` or more.

    One pass: a stretch grows while its sum is positive and less than `drop` below its
    largest value so far, and ends where that was; the next one begins at the character
    after which it closed. Positions are 0-based, `last` belongs to the stretch.
    """
    start = F.struct(
        F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0.0).alias("nats"), F.lit(0).alias("last"), F.lit(0).alias("at"),
        F.array().cast("array<struct<first:int,last:int,nats:double>>").alias("out"),
    )

    def closed(s: Column) -> Column:
        good = (s["nats"] >= evidence) & (s["last"] - s["first"] + 1 >= least)
        return F.when(good, F.concat(s["out"], F.array(F.struct(s["first"], s["last"], s["nats"])))).otherwise(s["out"])

    def step(s: Column, x: Column) -> Column:
        total, at = s["sum"] + x, s["at"] + 1
        last = F.when(total > s["nats"], at).otherwise(s["last"])
        over = (total <= 0) | (s["nats"] - total > drop)
        fresh = F.struct(F.lit(0.0).alias("sum"), at.alias("first"), F.lit(0.0).alias("nats"), at.alias("last"), at.alias("at"), closed(s).alias("out"))
        longer = F.struct(
            total.alias("sum"), s["first"].alias("first"), F.greatest(total, s["nats"]).alias("nats"), last.alias("last"), at.alias("at"), s["out"].alias("out")
        )
        return F.when(over, fresh).otherwise(longer)

    return F.aggregate(steps, start, step, closed)


def uncovered(runs: Column, spans: Column, least: int) -> Column:
    """`start, end, value` of what `spans` leave of `runs`, pieces of `least` characters or more.

    Runs do not touch; spans may overlap. Their edges are sorted once, and running sums say
    for every interval between two edges whether it lies in a run (1), in how many spans
    (2 each) and which run it is (8 each).
    """
    edge = lambda at, add: F.struct(at.alias("at"), F.lit(add).cast("long").alias("add"))
    edges = F.concat(
        F.transform(runs, lambda r: edge(r["start"], 9)), F.transform(runs, lambda r: edge(r["end"], -1)),
        F.transform(spans, lambda s: edge(s["start"], 2)), F.transform(spans, lambda s: edge(s["end"], -2)),
    )

    def cut(edges: Column) -> Column:
        def between(sums: Column) -> Column:
            one = lambda e, i: F.struct(e["at"].alias("start"), F.get(edges, i + 1)["at"].alias("end"), (F.get(sums, i) + e["add"]).alias("code"))
            free = lambda p: (p["end"] - p["start"] >= least) & (F.pmod(p["code"], F.lit(8)) == 1)
            return F.filter(F.transform(edges, one), free)

        return let(before(F.transform(edges, lambda e: e["add"])), between)

    def piece(p: Column) -> Column:
        run = F.get(runs, (F.shiftright(p["code"], 3) - 1).cast("int"))
        value = F.substring(run["value"], (p["start"] - run["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))
        return F.struct(p["start"].alias("start"), p["end"].alias("end"), value.alias("value"))

    return F.when(F.size(spans) == 0, runs).otherwise(F.transform(let(F.array_sort(edges), cut), piece))


def random_spans(pieces: Column, model: list[float], least: int, threshold: float, evidence: float, drop: float, slack: int = 3, distinct: int = 6) -> Column:
    """`start, end` of the random stretches of all pieces.

    A stretch sheds joining characters at its edges (a final `=` stays) and then takes up to
    `slack` letters or digits that part it from the next joining character or the edge of its piece. Stretches of fewer than `distinct` different characters are patterns.
    """
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def trimmed(value: Column, first: Column, last: Column) -> Column:
        body = F.substring(value, first + 1, last - first + 1)
        lead = F.char_length(F.regexp_extract(body, "^[/_=+-]+", 0))
        tail = F.char_length(F.regexp_extract(body, "[/_+-]+$", 0))
        head = F.when(lead == 0, F.regexp_extract(F.substring(value, F.greatest(first - slack - 1, F.lit(0)) + 1, F.least(first, F.lit(slack + 1))), f"(?<![A-Za-z0-9])[A-Za-z0-9]{{1,{slack}}}$", 0)).otherwise("")
        rest = F.when(tail == 0, F.regexp_extract(F.substring(value, last + 2, F.lit(slack + 1)), f"^[A-Za-z0-9]{{1,{slack}}}(?![A-Za-z0-9])", 0)).otherwise("")
        return F.struct((first + lead - F.char_length(head)).alias("first"), (last + 1 - tail + F.char_length(rest)).alias("end"))

    def of(p: Column) -> Column:
        found = F.filter(stretches(transitions(p["value"], model), least, evidence, drop), lambda s: s["nats"] > threshold * (s["last"] - s["first"]))
        edges = F.transform(found, lambda s: trimmed(p["value"], s["first"], s["last"]))
        varied = lambda e: F.size(F.array_distinct(F.split(F.substring(p["value"], e["first"] + 1, e["end"] - e["first"]), ""))) >= distinct
        kept = F.filter(edges, lambda e: (e["end"] - e["first"] >= least) & varied(e))
        return F.transform(kept, lambda e: F.struct((p["start"] + e["first"]).alias("start"), (p["start"] + e["end"]).alias("end")))

    return F.coalesce(F.flatten(F.transform(pieces, of)), none)


def joined(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(F.array_sort(spans), one))


def scan(
    docs: DataFrame, model: list[float], min_run: int = 12, threshold: float = 0.5, evidence: float = 20.0, drop: float = 10.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`doc_id, found`: all spans as an array of `start, rank, end, kind`, in order.

    A learned span has at least `min_run` characters, `evidence` nats in all and more than
    `threshold` nats per transition. By chance, ordinary text makes a stretch of 20 nats once in
    5e8 characters.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = [*BASE, LEARNED]
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"))
    rows = rows.withColumns({f"_{k}": s for k, s in base_spans(F.col("_t")).items()})
    runs = pattern_spans(F.col("_t"), f"(?<![{RUN}])[{RUN}]{{{min_run},}}", 0, min_run)
    base = F.concat(*[F.col(f"_{k}") for k in BASE])
    free = let(runs, lambda r: let(base, lambda b: uncovered(r, b, min_run)))
    rows = rows.withColumn(f"_{LEARNED}", let(free, lambda p: random_spans(p, model, min_run, threshold, evidence, drop)))
    form = lambda k: lambda s: F.struct(s["start"].alias("start"), F.lit(kinds.index(k)).alias("rank"), s["end"].alias("end"), F.lit(k).alias("kind"))
    return rows.select("doc_id", F.concat(*[F.transform(f"_{k}", form(k)) for k in kinds]).alias("found"))


def report(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, the digest of the fixed spans and all spans as text."""
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    fixed = F.filter("found", lambda s: s["kind"] != LEARNED)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(joined(fixed), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), count(LEARNED).alias(f"n_{LEARNED}")
    )

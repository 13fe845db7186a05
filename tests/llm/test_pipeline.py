"""The whole pipeline on small tables, against what each stage must do with planted rows."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from bulletin.llm import language_id

DOCS = "doc_id long, text string, source string, lang string, _row int, shard_docs string, held map<string,int>"
ITEMS = "item_id long, text string"


def planted():
    """Rows by what has to become of them."""
    r = random.Random(21)
    parts = {"en": ["the", "th", "ing", "and", "er"], "fr": ["eau", "le", "qu", "oi", "é"]}
    text = lambda lang, n: " ".join("".join(r.choice(parts[lang]) for _ in range(r.randrange(2, 5))) for _ in range(n))
    clean = [(i, text(("en", "fr")[i % 2], 40 + i), f"s{i % 3}" if i % 7 else None, ("en", "fr")[i % 2] if i % 5 else None) for i in range(80)]
    passage = text("en", 40)
    leaks = [(200 + i, f"{text('en', 30)} {passage} {text('en', 20)}", "s0", "en") for i in range(3)]
    copies = [(300 + i, clean[1][1], "s1", "fr") for i in range(4)] + [(301, clean[1][1], "s1", "fr")]
    noise = [(400, " ".join("".join(r.choices("qxzjkvw", k=6)) for _ in range(60)), "s2", None), (401, None, None, None), (402, "12 %%", "s2", "en"), (None, "", "s0", "en")]
    long = [(500, text("en", 20_000), "s0", "en")]
    return clean, leaks, copies, noise, long, passage


def tables(spark, folder, rows, items):
    full = [(*row, 1, "old", {"k": 1}) for row in rows]
    spark.createDataFrame(full, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_does_what_its_stages_say(spark, tmp_path):
    clean, leaks, copies, noise, long, passage = planted()
    rows = [*clean, *leaks, *copies, *noise, *long]
    where = tables(spark, tmp_path / "sf", rows, [(1, passage), (2, None), (3, "")])
    docs, kept = spark.read.parquet(f"{where}/documents.parquet"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, where)
        assert docs.columns == columns
        path = str(tmp_path / f"stage{len(kept)}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(Counter(r.doc_id for r in docs.select("doc_id").collect()))
    fine = [i for i, *_ in [*clean, *leaks, *copies, *long]]
    assert kept[0] == Counter(fine)
    assert kept[1] == Counter({i for i in fine if i < 300} | {500})
    assert kept[2] == Counter({i for i, *_ in clean} | {500})
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, where)
    assert mixed.columns == columns
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert set(times) <= set(kept[2]) and max(times.values()) <= 2
    out = corpus_pipeline.run(spark, where)
    assert out.columns == [c for c in columns if c != "shard_docs"] + ["shard", "shard_bytes", "shard_docs"]
    found = out.collect()
    assert Counter(r.doc_id for r in found) == times
    sizes = defaultdict(list)
    for r in found:
        sizes[r.shard].append(len(r.text.encode()))
    assert all((r.shard_bytes, r.shard_docs) == (sum(sizes[r.shard]), len(sizes[r.shard])) for r in found)
    assert all(r._row == 1 and r.held == {"k": 1} for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (1, None, None, None)]])
def test_pipeline_of_nothing_and_of_nulls(spark, tmp_path, rows):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path / "sf", rows, [])).count() == 0


def test_the_language_stage_learns_from_every_document(spark, tmp_path, monkeypatch):
    clean, _, _, noise, _, _ = planted()
    r = random.Random(5)
    # A language that only ids of one remainder hold.
    ids = [i for i in range(1_000, 1_200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rare = [(i, "".join(r.choices("的一是不了人我在有他这", k=60)), "s0", "zh") for i in ids]
    where = tables(spark, tmp_path / "sf", [*clean, *noise, *rare], [])
    docs, models = spark.read.parquet(f"{where}/documents.parquet"), []
    train = language_id.train
    monkeypatch.setattr(language_id, "train", lambda *args, **options: models.append(train(*args, **options)) or models[-1])
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, where).select("doc_id").collect()}
    assert kept == {i for i, *_ in [*clean, *rare]}
    whole = train(docs)
    assert models[0].langs == whole.langs == ["en", "fr", "zh"]
    assert models[0].usual.ravel().tolist() == pytest.approx(whole.usual.ravel().tolist(), rel=1e-9)

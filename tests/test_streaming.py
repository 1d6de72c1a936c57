"""The page stream against assembly of all pages at once."""

import random

from pyspark.sql import functions as F

from leafpress.operators import assemble as A
from leafpress.streaming import pages as stream

START, SEC = "@@RECIPE_START", "@@SECTION"


def random_book(rng, n_pages):
    pages, number = [], 0
    for p in range(n_pages):
        page = []
        if rng.random() < 0.5:
            number += 1
            page.append(f"{START} {number} 甲{number}")
        for _ in range(rng.randint(1, 6)):
            kind = rng.choice(["chapter", "sub", "start", "again", "promoted", "method", "main", "step", "text", "end", "foot", "notes", "plain"])
            number += kind == "start"
            page += {
                "chapter": [f"{SEC} 一、章{p}"], "sub": [f"{SEC} 甲{p % 10}类", f"{START} {number + 1} 乙"], "start": [f"{START} {number} 丙"], "again": [f"{START} {max(1, number)} 丁"],
                "promoted": [f"{SEC} （{rng.randint(1, 9)}）戊", f"{SEC} 〔主料〕"], "method": [f"{SEC} 制法"], "main": [f"{SEC} 主料"], "step": ["@@STEP 1"], "text": [f"x{rng.randint(0, 9)}"], "end": ["完。"], "foot": ["@@FOOTER 1"],
                "notes": [f"{SEC} 注释"], "plain": [f"（{rng.randint(1, 9)}）己"],
            }[kind]
        pages.append("\n".join((["@@RECIPE_CONT"] if page and not page[0].startswith(START) and rng.random() < 0.4 else []) + page))
    return pages


def rows(df):
    return sorted(map(str, df.select("book", *sorted(c for c in df.columns if c != "book")).collect()))


def test_stream_equals_assembly_of_everything(spark, tmp_path, monkeypatch):
    """Pages in several batches: in order, late ones, changed ones and ones that came before; they leave what a whole assembly gives."""
    rng = random.Random(12)
    books = {f"b{k}": random_book(rng, 14) for k in range(6)}
    flat = [(b, p, t) for b, pages in books.items() for p, t in enumerate(pages)]
    assembled = []
    monkeypatch.setattr(stream, "assemble", lambda pages, *a, **k: assembled.append({(r["book"], r["page"]) for r in pages.select("book", "page").collect()}) or A.assemble(pages, *a, **k))
    late = set(rng.sample(flat, 12))
    batches = [
        [x for x in flat if x[1] < 8 and x not in late],
        [x for x in flat if x[1] >= 8 and x not in late],
        sorted(late),
        [(b, p, t + "\nx") for b, p, t in flat if b == "b3" and p in (6, 9)] + [x for x in flat if x[0] == "b5"],
        [x for x in flat if x[0] in ("b1", "b2")],
    ]
    schema = "book string, page int, text string"
    held = {}
    for n, batch in enumerate(batches):
        held |= {(b, p): t for b, p, t in batch}
        stream.refresh_books(spark.createDataFrame(batch, schema), str(tmp_path / "pages"), str(tmp_path / "out"))
        if n != 3:  # by then the tables hold what all batches left
            continue
        whole = A.assemble(spark.createDataFrame([(b, p, t) for (b, p), t in held.items()], schema))
        for name in ("recipes", "blocks"):
            stored = spark.read.parquet(str(tmp_path / f"out/{name}"))
            assert rows(stored.select(*whole[name].columns)) == rows(whole[name]), (n, name)
    assert len(assembled) == 4  # the last batch has nothing new
    assert {b for b, _ in assembled[3]} == {"b3"}
    first = min(p for _, p in assembled[3])
    starts = [p for p in range(6) if books["b3"][p].startswith(START)]
    assert first == (max(starts) if starts else 0)
    assert len(assembled[1]) < len({(b, p) for b, p in held})


def test_no_folder_of_another_book_is_opened(spark, tmp_path):
    schema = "book string, page int, text string"
    path = str(tmp_path / "pages")
    stream.refresh_books(spark.createDataFrame([("007", 0, f"{START} 1 甲"), ("7", 0, f"{START} 1 乙")], schema), path, str(tmp_path / "out"))
    touched = spark.createDataFrame([("007",)], "book string")
    rows_ = stream._stored(spark, path, touched, stream._PAGES)
    assert [r["text"] for r in rows_.collect()] == [f"{START} 1 甲"]
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(book" in plan


def test_scan_of_a_stream(spark, tmp_path):
    folder = tmp_path / "in/a/_pages"
    folder.mkdir(parents=True)
    (folder / "p0001.md").write_text("x\nmail a@b.com")
    (folder / "p0002.md").write_text("nothing")
    found = stream.stream_scan(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("found").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    found.awaitTermination()
    assert [tuple(r) for r in spark.sql("select path, label, line from found").collect()] == [("a/1", "e-mail", 2)]

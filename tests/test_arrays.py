"""JSON array files of any layout, cut into small blocks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakemart.sources import arrays
from lakemart.sources.loads import load_raw
from lakemart.streaming.loads import stream_raw

HOSTILE = ['}', '"', '\\', '\\"}', '],[', '{"a":1},', "\n  },\n  {", "é漢😀", "", "]", "[", "x" * 700, '"}]']


def documents(seed, n):
    draw = random.Random(seed)

    def value(depth):
        kind = draw.randrange(5 if depth else 3)
        if kind == 0:
            return "".join(draw.choices(HOSTILE, k=draw.randrange(4)))
        if kind == 1:
            return draw.choice([None, True, 7, -1.5])
        if kind == 2:
            return draw.choice([{}, [], ""])
        if kind == 3:
            return [value(depth - 1) for _ in range(draw.randrange(3))]
        return {draw.choice(HOSTILE) + str(i): value(depth - 1) for i in range(draw.randrange(3))}

    return [{"id": i, "v": value(3)} for i in range(n)]


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def read(spark, path):
    found = arrays.read_json_any(spark, str(path)).select(F.to_json("raw_data"), "_metadata.file_path").collect()
    return sorted((path.rsplit("/", 1)[-1], json.dumps(json.loads(text), sort_keys=True)) for text, path in found)


def test_every_layout_in_one_drop(spark, small_blocks, tmp_path):
    forms = {
        "compact.json": lambda d: json.dumps(d, separators=(",", ":")),
        "spaced.json": lambda d: "\n\n " + json.dumps(d, ensure_ascii=False) + " \n",
        "two.json": lambda d: json.dumps(d, indent=2, ensure_ascii=False),
        "tabs.json": lambda d: json.dumps(d, indent="\t") + "\n",
        "lines.json": lambda d: "\n".join(map(json.dumps, d)),
        "ended_lines.json": lambda d: "".join(json.dumps(x) + "\r\n" for x in d),
        "arrays.json": lambda d: "[]\n" + "\n".join(json.dumps(d[i : i + 3]) for i in range(0, len(d), 3)) + "\n[]",
    }
    want = []
    for seed, (name, form) in enumerate(forms.items()):
        made = documents(seed, 60)
        (tmp_path / name).write_text(form(made), encoding="utf-8")
        want += [(name, json.dumps(x, sort_keys=True)) for x in made]
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert read(spark, tmp_path) == sorted(want)


@pytest.mark.parametrize("text, want", [("[]", []), ("", []), (" \n", []), ('[{"a": 1}]', [{"a": 1}]), ("[1, {}, [2, {}], null]", [1, {}, [2, {}], None]), ('[[{"a": "]"}], "}"]', [[{"a": "]"}], "}"])])
def test_odd_files(spark, tmp_path, text, want):
    (tmp_path / "a.json").write_text(text)
    assert [json.loads(t) for _, t in read(spark, tmp_path)] == sorted(want, key=lambda x: json.dumps(x, sort_keys=True))


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1', '[{"a": 1},', '[{"a": 1} {"a": 2}', '[{"a": "x}]', '[{"a": 1},{"b": tru}]', '[{"a": 1}]]'])
@pytest.mark.parametrize("repeat", [1, 100])
def test_broken_files_fail(spark, small_blocks, tmp_path, text, repeat):
    (tmp_path / "a.json").write_text(text.replace('[', '[' + '{"a": 0},' * (repeat - 1), 1))
    with pytest.raises(Exception):
        read(spark, tmp_path)


def test_one_document_over_many_blocks(spark, small_blocks, tmp_path):
    made = [{"a": 1}, {"long": ["{", {"x": "}" * 5000}, "]" * 3000] * 3}, {"b": [{"c": i} for i in range(500)]}]
    (tmp_path / "a.json").write_text(json.dumps(made))
    assert read(spark, tmp_path) == sorted(("a.json", json.dumps(x, sort_keys=True)) for x in made)


def test_loads_and_streams_of_arrays(spark, lake, small_blocks, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    for i in range(3):
        (drop / f"{i}.json").write_text(json.dumps(documents(i, 40), indent=2 if i else None))
    assert load_raw(lake, "raw_web_events", str(drop), "run-a", array_files=True) == 120
    for _ in range(2):
        stream_raw(lake, "raw_products", str(drop), str(tmp_path / "ckpt"), files_per_batch=2, array_files=True).awaitTermination()
    rows = lake.table(lake.raw, "raw_products")
    assert rows.count() == 120 and rows.select("_run_id").distinct().count() == 2
    assert rows.select("_source_file").distinct().count() == 3
    texts = [sorted(r[0] for r in lake.table(lake.raw, t).select(F.to_json("raw_data")).collect()) for t in ("raw_products", "raw_web_events")]
    assert texts[0] == texts[1]

"""Long JSON lists read in byte ranges: the same records as one parse of the whole file."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapworks.sources import long_lists, payloads


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "16", "spark.sql.files.minPartitionNum": "64"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def read(spark, folder):
    entries, bad = long_lists.read_entries(spark, str(folder))
    got: dict = {}
    for r in entries.collect():
        got.setdefault(r.source.rsplit("/", 1)[1], {})[r.pos] = json.loads(r.content)
    lists = {}
    for name, by_pos in got.items():
        assert sorted(by_pos) == list(range(len(by_pos)))
        lists[name] = [by_pos[i] for i in range(len(by_pos))]
    return lists, {r.source.rsplit("/", 1)[1]: r["shape"] for r in bad.collect()}


TRICKY = [
    {"a": 1, "b": "x}y{[,]\\"}, {"q": 'say "}," \\" \\\\', "n": {"deep": [{"x": [1, 2, {"y": "}"}]}]}}, 7, "plain, text}", [1, [2, {}]],
    None, True, {}, {"é漢🙂": "ü}" * 40}, {"long": "z" * 500, "tail": {"k": [{}] * 30}}, -1.5e3, "",
]


def test_ranges_of_tricky_lists(small_splits, tmp_path):
    spark = small_splits
    rnd = random.Random(4)
    want = {}
    for i, kw in enumerate([{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}]):
        data = [rnd.choice(TRICKY) for _ in range(60)]
        want[f"f{i}.json"] = data
        (tmp_path / f"f{i}.json").write_text(" \n" * (i % 2) + json.dumps(data, **kw) + "\n" * (i % 3))
    (tmp_path / "none.json").write_text(" [ \n ] ")
    for name, text in {"object.json": '{"detail": [1, 2]}', "cut.json": '[{"a": 1}, {"b": ', "empty.json": "", "open.json": '[{"a": "x}',
                       "more.json": "[1] [2]", "extra.json": '[{"a": 1}]}', "text.json": "no json"}.items():
        (tmp_path / name).write_text(text)
    lists, bad = read(spark, tmp_path)
    assert lists == want
    assert bad == {"object.json": "object", "cut.json": "unparsable", "open.json": "unparsable",
                   "more.json": "unparsable", "extra.json": "unparsable", "text.json": "unparsable"}


def test_many_tasks_read_one_file(small_splits, tmp_path):
    spark = small_splits
    (tmp_path / "one.json").write_text(json.dumps([{"i": i, "t": "x" * (i % 50)} for i in range(400)]))
    rows = long_lists._rows(spark, str(tmp_path))
    assert rows.select("block").distinct().count() >= 16 and rows.rdd.getNumPartitions() >= 16
    recs, bad = long_lists.read_records(spark, str(tmp_path))
    typed = payloads.to_columns(recs)
    assert sorted((r.i, len(r.t), r.pos) for r in typed.collect()) == [(i, i % 50, i) for i in range(400)]
    assert bad.count() == 0


def test_same_as_whole_payloads(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, 7, {"a": "x", "b": [1, 2]}]')
    (tmp_path / "b.json").write_text('{"detail": "no"}')
    whole = payloads.read_landed(spark, str(tmp_path))
    recs, bad = long_lists.read_records(spark, str(tmp_path))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(payloads.to_columns(recs)) == key(payloads.to_columns(payloads.explode_records(whole)))
    assert sorted(r.reason for r in bad.collect()) == sorted(r.reason for r in payloads.rejected(whole).collect())


values = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text('ab"\\{}[],: é🙂', max_size=12)),
                      lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.text('k"}', max_size=3), x, max_size=3)), max_leaves=8)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(values, max_size=12), min_size=4, max_size=8))
def test_any_lists(small_splits, tmp_path_factory, lists):
    folder = tmp_path_factory.mktemp("any")
    for i, data in enumerate(lists):
        (folder / f"{i}.json").write_text(json.dumps(data, ensure_ascii=bool(i % 2)))
    got, bad = read(small_splits, folder)
    assert bad == {} and got == {f"{i}.json": data for i, data in enumerate(lists) if data}

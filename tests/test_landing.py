from __future__ import annotations

import os

import pytest

from accountloom.schemas import ENTITIES, source_schema
from accountloom.sources import files, landing
from tests.support import rows, settings, source

DAY = "2025-01-01"


def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def _inputs(spark, folder):
    paths = {}
    for entity in ENTITIES:
        paths[entity] = f"{folder}/in/{entity}.csv"
        landing.write_source(source(spark, entity, {"customer_id": "1"}), paths[entity])
    return paths


def test_text_survives_the_round_trip(spark, folder):
    notes = ["  padded ", 'says "hi", twice', "a,b", "tab\there", '{"k": "v\\\\"}', "é", None, '"']
    src = source(
        spark, "activities", *[{"activity_id": str(i), "notes": n} for i, n in enumerate(notes)]
    )
    landing.write_source(src, f"{folder}/a.csv")
    assert rows(landing.read_source(spark, f"{folder}/a.csv", "activities")) == rows(src)


def test_empty_fields_are_null(spark, folder):
    path = _file(folder, "s.csv", 'subscription_id,customer_id,plan,mrr,renewal_date,status\n1,,"",,x,\n')
    got = landing.read_source(spark, path, "subscriptions").collect()
    assert [tuple(r) for r in got] == [("1", None, None, None, "x", None)]


def test_a_wrong_header_fails_the_read_unless_names_are_taken_from_it(spark, folder):
    path = _file(
        folder, "d.csv", "customer_id,deal_id,deal_value,close_date,deal_stage,owner,extra\n7,1,5,,won,r,e\n"
    )
    with pytest.raises(Exception, match="CSV header"):
        landing.read_source(spark, path, "deals").collect()
    got = landing.read_source(spark, path, "deals", any_header_order=True).collect()
    assert [tuple(r) for r in got] == [("1", "7", "5", "won", None, "r")]


def test_line_breaks_inside_quotes(spark, folder):
    path = _file(
        folder,
        "m.csv",
        'activity_id,customer_id,activity_type,timestamp,outcome,notes\n1,2,call,,,"two\nlines"\n',
    )
    got = landing.read_source(spark, path, "activities", multi_line=True).collect()
    assert [r.notes for r in got] == ["two\nlines"]


def test_a_missing_source_lands_nothing(spark, folder):
    inputs = _inputs(spark, folder)
    with pytest.raises(FileNotFoundError, match="subscriptions"):
        landing.land_sources(
            spark, {**inputs, "subscriptions": f"{folder}/none.csv"}, f"{folder}/zone", DAY
        )
    with pytest.raises(FileNotFoundError, match="deals"):
        some = {e: p for e, p in inputs.items() if e != "deals"}
        landing.land_sources(spark, some, f"{folder}/zone", DAY)
    assert not os.path.exists(f"{folder}/zone/raw/crm/{DAY}") and not _left(f"{folder}/zone")


def _left(zone):
    """Whatever a failed landing left behind."""
    return [name for _, _, names in os.walk(zone) for name in names]


def test_a_day_reads_its_own_folder(spark, folder):
    base = f"{folder}/zone"
    landing.land_sources(spark, _inputs(spark, folder), base, DAY)
    later = source(spark, "deals", {"deal_id": "5"}, {"deal_id": "6"})
    landing.write_source(later, landing.raw_path(base, "2025-01-02", "deals"))
    read = landing.read_run(spark, base, DAY)
    assert set(read) == set(ENTITIES)
    assert read["deals"].count() == 1
    with pytest.raises(FileNotFoundError):
        landing.read_run(spark, base, "2025-01-02")


def test_processing_a_day_again_replaces_it(spark, folder):
    for text in ("a", "b"):
        df = source(spark, "deals", {"deal_id": text})
        landing.write_processed(df, folder, DAY, "deals")
    assert [r.deal_id for r in landing.read_processed(spark, folder, DAY, "deals").collect()] == ["b"]


def test_expired_folders_of_both_zones_are_deleted(spark, folder):
    df = source(spark, "deals", {"deal_id": "1"})
    for day in ("2024-12-01", "2024-12-02", "2024-12-03"):
        landing.write_source(df, landing.raw_path(folder, day, "deals"))
    landing.write_processed(df, folder, "2024-12-01", "deals")
    landing.write_source(df, f"{folder}/raw/crm/notes/deals.csv")
    dropped = landing.drop_expired_folders(spark, folder, "2025-01-01", 30)
    assert [d.isoformat() for d in dropped] == ["2024-12-01", "2024-12-02"]
    assert sorted(os.listdir(f"{folder}/raw/crm")) == ["2024-12-03", "notes"]
    assert os.listdir(f"{folder}/processed/crm") == []
    assert landing.drop_expired_folders(spark, f"{folder}/none", "2025-01-01") == []


HEADER = "deal_id,customer_id,deal_value,deal_stage,close_date,owner"


def test_a_wrong_header_or_an_empty_folder_lands_nothing(spark, folder):
    inputs = _inputs(spark, folder)
    swapped = _file(f"{folder}/bad", "deals.csv", HEADER.replace("deal_id,customer_id", "customer_id,deal_id") + "\n1,2,3,a,,b\n")
    with pytest.raises(Exception, match="CSV header"):
        landing.land_sources(spark, {**inputs, "deals": swapped}, f"{folder}/zone", DAY)
    os.makedirs(f"{folder}/empty.csv")
    with pytest.raises(FileNotFoundError, match="deals"):
        landing.land_sources(spark, {**inputs, "deals": f"{folder}/empty.csv"}, f"{folder}/zone", DAY)
    assert not _left(f"{folder}/zone")


def test_lines_are_landed_as_they_are_and_damage_is_counted(spark, folder):
    lines = ["1,2,3.5,won,,rep", "2,2,3.5", '3,2,"4,5",won,,"a ""b"" c",extra,more', "4,2,  7 ,won,,\tx "]
    os.makedirs(f"{folder}/deals.csv")
    for n, part in enumerate((lines[:2], lines[2:], [])):
        _file(f"{folder}/deals.csv", f"{n}.csv", "\n".join([HEADER, *part, ""]))
    inputs = {**_inputs(spark, folder), "deals": f"{folder}/deals.csv"}
    found = landing.land_sources(spark, inputs, f"{folder}/zone", DAY)
    assert (found["deals"].rows, found["deals"].malformed) == (4, 2)
    assert found["customers"] == landing.Landed(1, 0)
    target = landing.raw_path(f"{folder}/zone", DAY, "deals")
    stored = [r.value for r in spark.read.text(target).collect()]
    assert sorted(x for x in stored if x != HEADER) == sorted(lines)
    assert HEADER in stored
    landed = landing.read_source(spark, target, "deals")
    assert rows(landed) == rows(landing.read_source(spark, f"{folder}/deals.csv", "deals"))


def test_sources_without_rows_are_landed(spark, folder):
    inputs = {**_inputs(spark, folder), "deals": _file(f"{folder}/none", "deals.csv", HEADER + "\n")}
    found = landing.land_sources(spark, inputs, f"{folder}/zone", DAY)
    assert found["deals"] == landing.Landed(0, 0)
    assert landing.read_run(spark, f"{folder}/zone", DAY)["deals"].count() == 0


def _bytes_of(path, header=HEADER):
    lines = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(f"{path}/{name}", "rb") as f:
                text = f.read()
            first, *rest = text.split(b"\n")
            assert first.decode() == header and text.endswith(b"\n")
            lines += rest[:-1]
    return sorted(lines)


def test_every_character_is_landed_as_it_is(spark, folder):
    marks = [bytes([c]) for c in range(256) if c != 10]
    lines = [b"1,2,3,won,," + m for m in marks] + [m + b"7,2,3,won,,x" for m in marks]
    lines += [b"#7,1,2,won,,x", b"\x01", b"\x00\x00", b"a\\", b'"', b"\xff\xfe,1", "é😀".encode(), b"1,2,3,won,,end\r"]
    os.makedirs(f"{folder}/deals.csv")
    for n in range(3):
        with open(f"{folder}/deals.csv/{n}.csv", "wb") as f:
            f.write(HEADER.encode() + b"\n" + b"\n".join(lines[n::3]) + b"\n" * (n % 2))
    inputs = {**_inputs(spark, folder), "deals": f"{folder}/deals.csv"}
    landing.land_sources(spark, inputs, f"{folder}/zone", DAY)
    assert _bytes_of(landing.raw_path(f"{folder}/zone", DAY, "deals")) == sorted(lines)


def test_many_tasks_each_write_the_header(spark, folder):
    lines = [f"{i},2,3,won,,{'x' * 40}" for i in range(20_000)]
    path = _file(folder, "deals.csv", "\n".join([HEADER, *lines, ""]))
    with settings(spark, spark__sql__files__maxPartitionBytes="100k", spark__sql__files__openCostInBytes="1k"):
        assert landing.copy_lines(spark, path, f"{folder}/out", "deals") == landing.Landed(20_000, 0)
    assert len([n for n in os.listdir(f"{folder}/out") if n.startswith("part-")]) > 4
    assert _bytes_of(f"{folder}/out") == sorted(x.encode() for x in lines)


def test_counts_are_those_of_a_parser(spark, folder):
    lines = ["1,2", "a,b,c,d,e,f,g", '"x"', '1,2,3,4,5,"6', "", "   ", "\t", "1,2,3,4,5,6", ",,,,,", ",", 'a"b,,,,,', '"a""b",1,2,3,4,5']
    path = _file(folder, "deals.csv", "\n".join([HEADER.replace("deal_id", '"Deal_ID"'), *lines, ""]))
    schema = source_schema("deals").add("bad", "string")
    options = {"header": True, "escape": '"', "columnNameOfCorruptRecord": "bad", "columnPruning": False}
    parsed = spark.read.options(**options).schema(schema).csv(path).collect()
    wanted = landing.Landed(len(parsed), sum(r.bad is not None for r in parsed))
    assert landing.copy_lines(spark, path, f"{folder}/out", "deals") == wanted


@pytest.mark.parametrize("options", [{"any_header_order": True}, {"multi_line": True}, {"any_header_order": True, "multi_line": True}])
def test_damage_is_counted_where_records_are_rewritten(spark, folder, options):
    header = "owner,deal_id,customer_id,deal_value,deal_stage,close_date,more" if "any_header_order" in options else HEADER
    n = header.count(",")
    lines = [",".join("abcdefg"[: n + 1]), "x,y", "," * n, "," * (n + 3)]
    path = _file(folder, "deals.csv", "\n".join([header, *lines, ""]))
    found = landing.land_sources(spark, {**_inputs(spark, folder), "deals": path}, f"{folder}/zone", DAY, **options)
    assert found["deals"] == landing.Landed(4, 2)
    landed = landing.read_run(spark, f"{folder}/zone", DAY)["deals"]
    assert landed.count() == 4 and landed.filter("deal_id IS NOT NULL").count() == 2


def test_each_source_is_read_once(spark, folder):
    """Only the write reads lines; the other job looks at sizes."""
    path = _file(folder, "deals.csv", "\n".join([HEADER, *["1,2,3,won,,x"] * 50, ""]))
    opened = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics()
    read = lambda: opened.get("file").getLong("bytesRead") or 0
    before = read()
    landing.copy_lines(spark, path, f"{folder}/out", "deals")
    size = os.path.getsize(path)
    assert size <= read() - before < 2 * size


def test_a_day_is_landed_again_in_one_step(spark, folder, monkeypatch):
    inputs, base = _inputs(spark, folder), f"{folder}/zone"
    landing.land_sources(spark, inputs, base, DAY)
    more = {**inputs, "deals": _file(folder, "deals.csv", f"{HEADER}\n8,1,2,won,,x\n9,1,2,won,,x\n")}
    move = files.move

    def fail_on_the_way_in(spark, path, target):
        if "/_new-" in path:
            raise OSError("lost")
        move(spark, path, target)

    with monkeypatch.context() as m:
        m.setattr(files, "move", fail_on_the_way_in)
        with pytest.raises(OSError, match="lost"):
            landing.land_sources(spark, more, base, DAY)
    assert landing.read_run(spark, base, DAY)["deals"].count() == 1
    landing.land_sources(spark, more, base, DAY)
    assert landing.read_run(spark, base, DAY)["deals"].count() == 2
    assert os.listdir(f"{base}/raw/crm") == [DAY]

"""Single files in many ranges: the same records as a reader in one task, wherever the cuts fall."""

import json
import random

import pytest

from textmart import sources
from textmart.sources import ranges


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def whole_csv(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


@pytest.mark.parametrize("size", [1, 3, 7, 64, 10_000])
def test_csv_ranges_hold_each_record_once(tmp_path, size):
    rng = random.Random(size)
    for n in range(15):
        records = [tuple("".join(rng.choice(["a", "é", '"', "\n", "\r\n", ",", " "]) for _ in range(rng.randrange(0, 8))) for _ in range(3)) for _ in range(rng.randrange(1, 12))]
        text = "".join(",".join('"' + f.replace('"', '""') + '"' for f in r) + rng.choice(["\n", "\r\n"]) for r in records)
        text = text.rstrip("\r\n") if n % 2 else text
        file = tmp_path / f"{n}.csv"
        file.write_bytes(text.encode())
        total, found, quoted = len(text.encode()), [], False
        for start in range(0, total, size):
            end = min(start + size, total)
            data, places = ranges.whole_records(str(file), start, end, total, quoted)
            found += [data[low:high].tobytes().decode() for low, high in places]
            quoted ^= bool((ranges.bytes_of(str(file), start, end) == ranges.QUOTE).sum() % 2)
        import csv
        import io

        got = [tuple(next(csv.reader(io.StringIO(f.removesuffix("\r"), newline="")))) for f in found]
        assert got == records


def test_csv_files_equal_the_reader_in_one_task(spark, tmp_path):
    rng = random.Random(1)
    folder = tmp_path / "cache"
    folder.mkdir()
    for part in range(3):
        lines = [",".join('"' + f.replace('"', '""') + '"' for f in (str(rng.randrange(30)), "".join(rng.choice(["x", '"', "\n", ","]) for _ in range(rng.randrange(1, 9))))) for _ in range(40)]
        (folder / f"part{part}.csv").write_text("job_id,html_text\n" + "\n".join(lines) + "\n")
    records, header = ranges.csv_records(spark, str(folder), range_bytes=50)
    assert header == ["job_id", "html_text"]
    assert rows(records.selectExpr("fields[0]", "fields[1]")) == rows(whole_csv(spark, str(folder)))
    last = {}
    for file in sorted(folder.iterdir()):
        for r in whole_csv(spark, str(file)).collect():
            last[r.job_id] = r.html_text or ""
    assert rows(sources.read_html_cache_csv(spark, str(folder), multi_line=True)) == sorted(last.items(), key=repr)
    assert rows(sources.read_html_cache_csv(spark, str(tmp_path / "missing"), multi_line=True)) == []


def elements(path, size):
    """What all ranges of a file give, with the states that running sums give them."""
    data = path.read_bytes()
    total, state, depth, out = len(data), False, 0, []
    for start in range(0, total, size):
        end = min(start + size, total)
        odd = ranges.backslashes_before(str(path), start)
        out += [(start + i, e) for i, e in ranges.range_elements(str(path), start, end, total, state, depth, odd)]
        part = ranges.bytes_of(str(path), start, end)
        free, _, last = ranges.outside(part, state, odd)
        depth, state = depth + int(ranges.depths(part, free)[-1]), last
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 33, 10_000])
def test_json_ranges_hold_each_object_once(tmp_path, size):
    rng = random.Random(size)
    file = tmp_path / "a.json"
    for _ in range(20):
        text = lambda: "".join(rng.choice(["a", '"', "\\", "{", "]", "é", "\n", ","]) for _ in range(rng.randrange(0, 9)))
        objects = [{text(): text(), "n": [1, {"x": text()}, []]} for _ in range(rng.randrange(0, 6))]
        file.write_text(json.dumps(objects, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) + rng.choice(["", " \n"]))
        assert [json.loads(e) for _, e in elements(file, size)] == objects
        whole = file.read_text().rstrip()
        for broken in (whole[: rng.randrange(len(whole))], whole + "x", whole + "[]", "x" + whole, whole.replace("[", "[,", 1), '["s"]', "[1]", "{}", '[{}{}]', "[{},]", "[null]"):
            if broken:
                file.write_text(broken)
                assert None in [e for _, e in elements(file, size)], broken


@pytest.mark.parametrize("content", [None, "", "  ", "[{broken", "[]", "not json", '[{"job_id": "1"}, {"job_id": ', '[{"job_id": "1"}, {"job_id" "2"}]'])
def test_json_array_reader_is_as_tolerant(spark, tmp_path, content):
    file = tmp_path / "entries.json"
    if content is not None:
        file.write_text(content)
    assert rows(sources.read_entries_json_array(spark, str(file), 7)) == rows(sources.read_entries_json(spark, str(file))) == []


def test_json_array_reader_equals_the_reader_in_one_task(spark, tmp_path):
    rng = random.Random(2)
    entries = [{"job_id": str(i), "title": rng.choice([None, 't "x" {', "\\"]), "skills": rng.choice([None, [], ["a", "]"]])} for i in range(200)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(entries, indent=1))
    (tmp_path / "in" / "b.json").write_text(json.dumps(entries[:50])[:-3])
    split = sources.read_entries_json_array(spark, str(tmp_path / "in"), 500)
    assert len(ranges.byte_ranges(spark, str(tmp_path / "in"), 500)) > 20
    assert rows(split) == rows(sources.read_entries_json(spark, str(tmp_path / "in"))) and split.count() == 200

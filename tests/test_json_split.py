"""JSON arrays cut at any byte: every tiling gives the elements of the whole file."""

import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordmill.operators import json_split
from recordmill.operators.framing import json_elements
from recordmill.operators.json_split import Entry, Growing, block_function, elements, first_character, json_records
from recordmill.sources.ranges import ChangedError, Pinned, listed, opened

TRICKS = ['{"id":1}', '","x":[{"id":9,"t":"', "\\", '\\"', '"', "]", "},{", '[{"id":2', "é", "日本", "\\u0041", ""]


def document(rng, broken):
    out = []
    for k in range(rng.randrange(0, 12)):
        text = "".join(rng.choice(TRICKS) for _ in range(rng.randrange(6)))
        e = json.dumps({"id": k, "t": text, "n": [{"id": 3, "u": [1, text]}]}, ensure_ascii=rng.random() < 0.5)
        kind = rng.random()
        if kind < 0.1:
            e = json.dumps([{"id": k}, text])
        elif kind < 0.2:
            e = rng.choice(["12", "null", '"{\\"id\\":5}"', "{}", '{"other":1,"id":2}'])
        elif broken and kind < 0.4:
            e = rng.choice(['{"id": tru}', '{"id":1 "x":2}', "{'id':[1,2]}", "nul l", '{"id":\\"a"}', "\\"])
        out.append(e)
    blank = lambda: rng.choice(["", " ", "\n\t", "\r\n  "])
    return (blank() + "[" + ",".join(blank() + e + blank() for e in out) + "]" + rng.choice(["", "\n", ' [{"id":7}]'])).encode()


def in_blocks(data, cuts, **more):
    """The elements of all blocks, each entered as the functions before it say."""
    entry, out = Entry(), []
    for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
        g = Growing(io.BytesIO(data), a, b, len(data))
        out += [(at, raw, reason) for at, raw, reason in elements(g, entry, b, "id", more.get("max_bytes", 0))]
        block = data[a:b]
        entry = entry.after(block_function(block), first_character(block))
    return out


@pytest.mark.parametrize("broken", [False, True])
def test_any_tiling_gives_the_whole_files_elements(broken):
    rng = random.Random(11)
    for _ in range(25):
        data = document(rng, broken)
        whole = in_blocks(data, [])
        if not broken:
            assert whole == list(json_elements(data, "id"))
        for cut in range(1, len(data)):
            assert in_blocks(data, [cut]) == whole
        for _ in range(10):
            cuts = sorted(rng.sample(range(1, len(data)), min(len(data) - 1, rng.randrange(1, 30))))
            assert in_blocks(data, cuts) == whole
            assert in_blocks(data, cuts, max_bytes=30) == in_blocks(data, [], max_bytes=30)


def test_no_array_and_large_elements():
    assert in_blocks(b'  {"id":1}', [3]) == [(2, b"", "MALFORMED_JSON")]
    assert in_blocks(b"   ", [1]) == [] and in_blocks(b"[]", [1]) == []
    big = b'[{"id":1,"t":"' + b'\\"' * 200_000 + b'"} ,' + b" " * 300_000 + b'{"id":2}]'
    assert [(a, len(r), e) for a, r, e in in_blocks(big, [7, 100_001, 400_010, 600_000])] == [(1, 400_015, None), (700_018, 8, None)]
    assert [(a, len(r), e) for a, r, e in in_blocks(big, [100_001], max_bytes=1000)] == [(1, 0, "OVERSIZED_RECORD"), (700_018, 8, None)]


def test_records_of_files(spark, tmp_path):
    rng, want = random.Random(5), []
    for k in range(6):
        data = document(rng, k % 2) + b" " * k
        (tmp_path / f"{k}.json").write_bytes(data)
        want += [(f"{k}.json", at, r.decode() if not e else None, e) for at, r, e in in_blocks(data, [])]
    (tmp_path / "empty.json").write_bytes(b"")
    for target in (3, 50, 10**6):
        got = json_records(spark, str(tmp_path), first_field="id", target=target)
        assert sorted((r.path.rsplit("/", 1)[1], r.byte_offset, r.raw, r.reason) for r in got.collect()) == sorted(want)
    assert json_records(spark, str(tmp_path), target=3).where(F.col("chunk_id") > "00000001").count() > 0


def test_files_of_two_file_systems_and_changes(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'[{"id":1},{"id":2}]')
    local = listed(str(tmp_path))
    assert local == listed(f"file://{tmp_path}")
    with opened(local[0]) as f:
        assert f.read() == b'[{"id":1},{"id":2}]'
    with pytest.raises(ChangedError), opened(Pinned(local[0].path, local[0].size, "0")):
        pass
    with pytest.raises(FileNotFoundError):
        listed(str(tmp_path / "none"))


def test_other_stores_go_through_pyarrow(spark, tmp_path, monkeypatch):
    """The same files as those of a store that is not mounted."""
    from recordmill.sources import ranges

    for k in range(3):
        (tmp_path / f"{k}.json").write_bytes(b'[{"id":%d}]' % k)
    monkeypatch.setattr(ranges, "mounted", lambda path: None)
    found = listed(f"file://{tmp_path}")
    assert [p.path for p in found] == [f"file://{tmp_path}/{k}.json" for k in range(3)] and {p.size for p in found} == {10}
    with opened(found[1]) as f:
        f.seek(2)
        assert f.read(6) == b'"id":1'
    with pytest.raises(ChangedError), opened(Pinned(found[1].path, 10, "1")):
        pass
    with pytest.raises(FileNotFoundError):
        listed(f"file://{tmp_path}/none")


def test_blocks_of_a_file_open_it_once_and_share_a_batch(spark, tmp_path, monkeypatch):
    opens, opened = [], json_split.opened
    monkeypatch.setattr(json_split, "opened", lambda file: opens.append(file.path) or opened(file))
    (tmp_path / "a").write_bytes(b"0123456789")
    (tmp_path / "b").write_bytes(b"abcdefghij")
    rows = [{"path": p.path, "size": p.size, "version": p.version, "start_byte": k} for p in json_split.listed(str(tmp_path)) for k in range(0, 10, 2)]
    batches = iter([pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])])
    got = [(f.seek(r["start_byte"]), f.read(2))[1] for r, f in json_split.with_files(batches)]
    assert b"".join(got) == b"0123456789abcdefghij" and len(opens) == 2
    (tmp_path / "c.json").write_text("[" + ",".join(f'{{"id":{k}}}' for k in range(300)) + "]")
    sizes = json_split.json_records(spark, str(tmp_path / "c.json"), first_field="id", target=40)
    assert sizes.count() == 300 and sizes.select("chunk_id").distinct().count() > 50

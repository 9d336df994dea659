import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordmill.operators.framing import Layout, frame, json_elements, multiline_records, text_batch, text_records
from recordmill.sources.framed import FramedFiles


def lines(data, **options):
    b = text_records(data, **options)
    return list(zip(b.column("byte_offset").to_pylist(), b.column("raw").to_pylist(), b.column("reason").to_pylist(), strict=True))


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        (b"", []),
        (b"a", [(0, "a")]),
        (b"a\nb\r\nc\rd", [(0, "a"), (2, "b"), (5, "c"), (7, "d")]),
        (b"\n\r", [(0, ""), (1, "")]),
        (b"\r\n\r\n", [(0, ""), (2, "")]),
        (b"a\n\nb\n", [(0, "a"), (2, ""), (3, "b")]),
        ("é \nü".encode(), [(0, "é "), (4, "ü")]),
    ],
)
def test_terminators_and_offsets(data, expected):
    assert [(a, b) for a, b, _ in lines(data)] == expected


def test_reasons_keep_their_place():
    assert lines(b"abc\nabcd\n\xff\nx", max_bytes=3, strict_end=True) == [(0, "abc", None), (4, None, "OVERSIZED_RECORD"), (9, None, "INVALID_UTF8"), (11, None, "UNTERMINATED_RECORD")]


def test_multiline_precedence_and_counters():
    layout = Layout(breaks=[(0, 1, "D")], includes=[(0, 1, "C")], ignores=[(0, 1, "X")])
    out = multiline_records(b"H\nD1\nC1\nX\nC2\nD2\nT\n", layout)
    assert [(a, b) for _, a, b in out.records] == [(2, b"D1\x1cC1\x1cC2"), (13, b"D2")]
    assert (out.headers, out.trailers) == (1, 2)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("[]", []),
        ("", []),
        ('{"id":1}', [(0, "", "MALFORMED_JSON")]),
        ('[{"id":1}, {"x":1,"id":2},3,"{\\"id\\":4}"]', [(1, '{"id":1}', None)]),
        ('[{"id":{"id":2}} , {"id":]}, {"id":"é]"}]', [(1, '{"id":{"id":2}}', None), (19, "", "MALFORMED_JSON"), (29, '{"id":"é]"}', None)]),
    ],
)
def test_json_elements(text, expected):
    found = [(a, b.decode(), r) for a, b, r in json_elements(text.encode(), "id")]
    assert found == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=20) | st.text(alphabet="aé\r\n", max_size=12).map(str.encode), max_size=6), st.booleans())
def test_contents_framed_together_as_alone(contents, strict):
    ends = np.cumsum([0, *map(len, contents)])
    which, out = text_batch(b"".join(contents), ends, 5, strict)
    alone = [text_records(c, max_bytes=5, strict_end=strict) for c in contents]
    assert which.tolist() == [i for i, b in enumerate(alone) for _ in range(b.num_rows)]
    assert out.to_pylist() == [r for b in alone for r in b.to_pylist()]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é\r\n", max_size=60), st.integers(1, 20))
def test_any_tiling_gives_the_same_lines(tmp_path_factory, text, target):
    from recordmill.sources.framed import FramedReader

    data = text.encode()
    folder = tmp_path_factory.mktemp("t")
    (folder / "f").write_bytes(data)
    reader = FramedReader({"path": str(folder / "f"), "targetchunkbytes": str(target)})
    got = [row for r in reader.partitions() for b in reader.read(r) for row in zip(b.column("byte_offset").to_pylist(), b.column("raw").to_pylist(), strict=True)]
    assert got == [(a, b) for a, b, _ in lines(data)]


def test_json_tiling(tmp_path):
    from recordmill.sources.framed import FramedReader

    rng = random.Random(8)
    item = lambda i: {"id": i, "text": "é{[\"" * rng.randrange(4), "kids": [{"id": -k} for k in range(rng.randrange(3))]}
    parts = [json.dumps(item(i), ensure_ascii=False) for i in range(120)]
    parts[50], parts[60], parts[70] = '{"id":1:2}', '{"other":1,"id":2}', "17"
    data = ("[" + ",\n ".join(parts) + "]").encode()
    (tmp_path / "f").write_bytes(data)

    def read(target):
        reader = FramedReader({"path": str(tmp_path / "f"), "mode": "json", "firstfieldname": "id", "maxrecordbytes": "150", "targetchunkbytes": str(target)})
        return [(x["byte_offset"], x["raw"], x["reason"]) for r in reader.partitions() for b in reader.read(r) for x in b.to_pylist()]

    whole = read(10**6)
    assert len(whole) == 118 and sum(x[2] is not None for x in whole) == 1
    for target in (60, 200, 1000):
        assert read(target) == whole, target


def test_borders_without_a_break_and_changed_files(tmp_path):
    from recordmill.sources.framed import BorderError, FramedReader

    (tmp_path / "f").write_bytes(b"ab\n" * 20 + b"x" * 500 + b"\nab\n")
    reader = FramedReader({"path": str(tmp_path / "f"), "targetchunkbytes": "100", "maxrecordbytes": "10"})
    with pytest.raises(BorderError):
        [b for r in reader.partitions() for b in reader.read(r)]
    lines_ = FramedReader({"path": str(tmp_path / "f"), "mode": "multi-line", "layout": '{"breaks": [[0, 1, "Q"]]}', "targetchunkbytes": "100", "maxrecordbytes": "10"})
    with pytest.raises(BorderError):
        [b for r in lines_.partitions() for b in lines_.read(r)]
    reader = FramedReader({"path": str(tmp_path / "f"), "targetchunkbytes": "100"})
    parts = reader.partitions()
    (tmp_path / "f").write_bytes(b"ab\n" * 20)
    with pytest.raises(ValueError, match="has changed"):
        list(reader.read(parts[0]))


def test_multiline_tiling(tmp_path):
    from recordmill.sources.framed import FramedReader

    rng = random.Random(3)
    data = b"".join(rng.choice([b"D", b"C", b"x", b"xD"]) + b"q" * rng.randrange(9) + rng.choice([b"\n", b"\r\n"]) for _ in range(200))
    (tmp_path / "f").write_bytes(data)
    layout = Layout(breaks=[(0, 1, "D")], includes=[(0, 1, "C")])
    whole = [(a, b.decode()) for _, a, b in multiline_records(data, layout).records]
    spec = '{"breaks": [[0, 1, "D"]], "includes": [[0, 1, "C"]]}'
    for target in (7, 50, 10_000):
        reader = FramedReader({"path": str(tmp_path / "f"), "mode": "multi-line", "layout": spec, "targetchunkbytes": str(target)})
        assert [x for r in reader.partitions() for b in reader.read(r) for x in zip(b.column("byte_offset").to_pylist(), b.column("raw").to_pylist(), strict=True)] == whole


def test_source_batch_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.txt").write_bytes(b"\n".join(b"%d-%d" % (k, i) for i in range(50)))
    spark.dataSource.register(FramedFiles)
    rows = spark.read.format("framed_file").option("path", str(tmp_path / "in")).option("targetChunkBytes", "60").load()
    assert rows.count() == 150 and rows.select("raw").distinct().count() == 150
    assert rows.where("chunk_id > '00000001'").count() > 0
    q = spark.readStream.format("framed_file").option("path", str(tmp_path / "in")).load().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 150


def test_frame_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a\nb")], "id int, content string")
    assert [tuple(r) for r in frame(df, F.col("content"), ["id"]).select("id", "ordinal", "raw").collect()] == [(3, 0, "a"), (3, 1, "b")]


def test_grouped_ranges_give_the_same_lines(tmp_path):
    from recordmill.sources.framed import FramedReader

    for k in range(20):
        (tmp_path / f"{k}.txt").write_bytes(b"".join(b"%d-%d\r\n" % (k, i) for i in range(k)))
    read = lambda **more: [tuple(x.values()) for r in FramedReader({"path": str(tmp_path), "targetchunkbytes": "7"} | more).partitions() for b in FramedReader({"path": str(tmp_path)}).read(r) for x in b.to_pylist()]
    few = FramedReader({"path": str(tmp_path), "targetchunkbytes": "7", "partitionbytes": "100"}).partitions()
    assert read(partitionbytes="100") == read() and sum(range(20)) == len(read())
    assert len(few) < 20 and all(sum(r.end - r.start + 1 for r in p.ranges) <= 100 for p in few)


def test_framed_source_text_reads_every_document(spark):
    from recordmill import catalog

    want = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text <> ''").count()
    rows = catalog.QUERIES["framed_source_text"](spark, "/root/testdata/sf0.001")
    assert rows.select("doc_id").distinct().count() == want > 50


def test_utf8_guard_looks_at_whole_lines(spark):
    from recordmill.catalog.scanning import damaged

    files = spark.createDataFrame([(1, "aé\nbé\r\ncdéf\rgh\n\nx"), (2, ""), (3, None)], "doc_id int, content string")
    data = {r.doc_id: r.content for r in damaged(files).collect()}
    assert bytes(data[1]) == b"a\xc3\xa9\n\xe6\x97b\xc3\xa9\r\ncd\xe6\x97\xc3\xa9f\rgh\xe6\x97\n\n\xe6\x97x"
    rows = frame(damaged(files), F.col("content"), ["doc_id"]).collect()
    assert [(r.ordinal, r.reason, r.raw) for r in rows] == [(i, "INVALID_UTF8" if i % 4 else None, {0: "aé", 4: ""}.get(i)) for i in range(6)]


def test_ranges_of_a_partition_share_files_and_batches(tmp_path, monkeypatch):
    from recordmill.sources import framed as source

    opens, opened = [], source.opened
    monkeypatch.setattr(source, "opened", lambda file: opens.append(file.path) or opened(file))
    for name in "ab":
        (tmp_path / name).write_text("".join(f"{name}{k}\n" for k in range(200)))
    reader = source.FramedReader({"path": str(tmp_path), "targetchunkbytes": "20", "partitionbytes": "1000000"})
    (part,) = reader.partitions()
    (batch,) = reader.read(part)
    assert len(part.ranges) > 40 and len(opens) == 2
    assert batch.column("raw").to_pylist() == [f"{name}{k}" for name in "ab" for k in range(200)]

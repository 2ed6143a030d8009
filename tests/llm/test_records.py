import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import ranges, records
from riskloom.session import scratch_path


def expected(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def placed(rows):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=lambda r: r[1])


@pytest.mark.parametrize("rows_per_file", [7, 4096])
def test_files_hold_all_records_in_order(spark, documents, odd_rows, rows_per_file):
    index = records.write_records(documents(odd_rows), scratch_path(spark, "r"), rows_per_file=rows_per_file)
    assert placed(records.record_digests(index).collect()) == expected(odd_rows)


def test_shuffled_reads_find_the_same(spark, documents, odd_rows):
    index = records.write_records(documents(odd_rows), scratch_path(spark, "r"), rows_per_file=10)
    read = records.read_records(index, seed=4).collect()
    assert placed(read) == expected(odd_rows)
    some = records.read_records(index.where("n_tokens = 1"), seed=4).collect()
    assert {r["n_tokens"] for r in some} == {1}


def test_small_reads_join(spark, documents, odd_rows, monkeypatch):
    index = records.write_records(documents(odd_rows), scratch_path(spark, "r"))
    monkeypatch.setattr(records, "_READ_BYTES", 64)
    reader, lines = ranges.RangeReader(), 0
    for path, length in index.select("path").distinct().join(
        spark.read.format("binaryFile").load(index.first()["path"].rsplit("/", 1)[0]).select("path", "length"), "path"
    ).collect():
        lines += sum(len(rows) for rows in records._scan(reader, path, length))
    assert lines == len(odd_rows)


def test_files_follow_by_key_not_by_name(spark, tmp_path):
    (tmp_path / "records").mkdir()
    keys = {"part-10001.txt": [None, 3], "part-100000.txt": [4, 4, 9], "part-00002.txt": [11]}
    for name, held in keys.items():
        packed = [records.pack_record(k, np.array([7] * (n + 2), "<u4").tobytes(), 2) for n, k in enumerate(held)]
        (tmp_path / "records" / name).write_bytes(b"".join(r + records.GUARD for r in packed))
    index = records.write_index(spark, f"file://{tmp_path}").orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in index] == [
        (None, 0, 2), (3, 2, 3), (4, 5, 2), (4, 7, 3), (9, 10, 4), (11, 14, 2),
    ]


def test_damage_is_noticed():
    record = bytearray(records.pack_record(5, np.array([1, 2, 3], "<u4").tobytes(), 2) + records.GUARD)
    key, ids, end = records.unpack_record(memoryview(bytes(record)), 0, "x")
    assert (key, ids.tolist(), end) == (5, [1, 2, 3], len(record))
    for at in (0, 9, 15, len(record) - 3):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            records.unpack_record(memoryview(bytes(broken)), 0, "x")


def test_empty_table(spark, documents):
    index = records.write_records(documents([]), scratch_path(spark, "r"))
    assert records.record_digests(index).collect() == []

import io
import tarfile

import pytest

from corpusloom.sources import archives, files


def made(entries, mode):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, body in entries:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
    return out.getvalue()


ENTRIES = [(f"valid/PMC{i}.xml", bytes([65 + i % 26]) * (i * 997)) for i in range(12)]


@pytest.mark.parametrize("suffix,mode", [(".tar", "w"), (".tar.gz", "w:gz"), (".tar.bz2", "w:bz2"), (".TGZ", "w:gz")])
def test_members_of_files(spark, tmp_path, monkeypatch, suffix, mode):
    monkeypatch.setattr(archives, "RANGE_BYTES", 4096)
    monkeypatch.setattr(archives, "BATCH_BYTES", 3000)
    for n in range(3):
        (tmp_path / f"a{n}{suffix}").write_bytes(made(ENTRIES, mode))
    (tmp_path / "other.txt").write_text("no archive")
    found = archives.members(spark, str(tmp_path)).collect()
    assert len(found) == 36 and {r.error for r in found} == {None}
    assert sorted((r.name, bytes(r.body)) for r in found) == sorted(ENTRIES * 3)
    assert all(r.size == len(r.body) for r in found)
    some = archives.members(spark, str(tmp_path), only=r"PMC1\.xml").collect()
    assert [r.name for r in some] == ["valid/PMC1.xml"] * 3
    assert files.corpus_ids(spark, str(tmp_path / f"a0{suffix}")).count() == 12


@pytest.mark.parametrize("suffix,mode", [(".tar", "w"), (".tar.gz", "w:gz"), (".tar.bz2", "w:bz2")])
def test_a_broken_archive_says_so(spark, tmp_path, suffix, mode):
    whole = made(ENTRIES, mode)
    (tmp_path / f"whole{suffix}").write_bytes(whole)
    (tmp_path / f"cut{suffix}").write_bytes(whole[: len(whole) * 2 // 3])
    (tmp_path / f"none{suffix}").write_bytes(b"this is not an archive at all")
    by = {}
    for r in archives.members(spark, str(tmp_path)).collect():
        by.setdefault(r.path.rpartition("/")[2].partition(".")[0], []).append((r.name, r.error))
    assert sorted(n for n, _ in by["whole"]) == sorted(n for n, _ in ENTRIES) and not any(e for _, e in by["whole"])
    assert [n for n, e in by["none"]] == [None] and by["none"][0][1]
    assert sum(e is not None for _, e in by["cut"]) == 1 and {n for n, e in by["cut"] if not e} < {n for n, _ in ENTRIES}
    values = spark.createDataFrame([("w", bytearray(whole)), ("c", bytearray(whole[: len(whole) * 2 // 3])), ("n", None)], "path string, content binary")
    told = files.tar_members(values).collect()
    assert sorted({r.path for r in told if r.error}) == ["c"] and sum(r.path == "w" for r in told) == 12


def test_an_archive_cut_between_members_says_so(spark, tmp_path):
    (tmp_path / "a.tar").write_bytes(made(ENTRIES[:1], "w")[:512])  # one empty member, then nothing
    found = archives.members(spark, str(tmp_path)).collect()
    assert sorted((r.name, r.error) for r in found if r.name) == [("valid/PMC0.xml", None)] and [r.error for r in found if r.error] == ["EOFError: no end of archive"]


def test_archives_in_values_take_little_memory():
    """Making archives leaves nothing for the collector; their members come in batches of many archives, none of them large."""
    import gc

    import pyarrow as pa

    from corpusloom.plans import journeys, registry
    from corpusloom.sources import archives

    n = 3000
    texts = pa.record_batch({"doc_id": pa.array(range(n)), "path": [str(i) for i in range(n)], "text": ["x" * 100] * n, "pmcid": ["pmc1"] * n, "doi": ["10.1/a"] * n})
    for made in (registry._tarred, journeys._packed):
        gc.collect()
        gc.disable()
        try:
            batches = list(made(iter([texts])))
            assert gc.collect() < 100  # a file of gzip was such a circle, one for each archive
        finally:
            gc.enable()
        assert max(b.num_rows for b in batches) <= archives.SLICE and [p for b in batches for p in b["path"].to_pylist()] == texts["path"].to_pylist()
    rows = [{"path": str(i), "name": "a", "size": 0, "body": b"", "offset": 0, "error": None} for i in range(n * 3)]
    assert [b.num_rows for b in archives.batched(iter(rows))] == [archives.BATCH_ROWS, archives.BATCH_ROWS, 3 * n - 2 * archives.BATCH_ROWS]

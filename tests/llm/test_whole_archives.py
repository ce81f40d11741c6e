"""Every archive with records embeds a dictionary and is read back whole."""

import random
import struct

import pytest
import zstandard

from timeline_engine.llm import warc_dict as W


def records(n, size):
    rng = random.Random(n)
    return [W.record(k, f"http://h/{k}", bytes(rng.choices(b"abcdefgh <>", k=size)), "0" * 64, None) for k in range(n)]


@pytest.mark.parametrize("n, size", [(1, 300), (3, 2_000_000), (15, 500), (40, 800), (16, 1)])
def test_archive_of_few_records(n, size):
    made = records(n, size)
    data = W.archive(made)
    embedded = struct.unpack_from("<I", data, 4)[0]
    assert 0 < embedded <= W.DICTIONARY_BYTES + 1024
    found = list(W.read_archive(data))
    assert [b for _, b in found] == [r.split(b"\r\n\r\n", 1)[1][:-4] for r in made]
    with pytest.raises(zstandard.ZstdError):  # the records lean on the dictionary
        zstandard.ZstdDecompressor().decompress(zstandard.ZstdCompressor(level=W.LEVEL, dict_data=W.build_dictionary(made), write_checksum=True).compress(made[0]))


def test_similar_pages_of_a_short_archive_are_smaller():
    page = bytes(random.Random(5).choices(b"abcdefgh <>", k=3000))
    made = [W.record(k, f"http://h/{k}", page + str(k).encode(), "0" * 64, None) for k in range(10)]
    plain = sum(len(zstandard.ZstdCompressor(level=W.LEVEL, write_checksum=True).compress(r)) for r in made)
    assert len(W.archive(made)) < plain / 2


def test_no_records():
    assert list(W.read_archive(W.archive([]))) == []


def test_archives_in_a_store_that_only_spark_reads(spark, tmp_path):
    """A Hadoop-only scheme: written and read by Spark, each file a valid stream."""
    (tmp_path / "store").mkdir()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.warcs.link./w", f"file://{tmp_path}/store")
    pages = [(k, f"http://h/{k}", f"<p>page {k} " + "of the archive \u00e9\x00 " * 20) for k in range(120)]
    pages += [(k, None, f"<p>{k} " + "long " * 200_000) for k in range(200, 240)]  # several archives
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    archives = W.write_archives(df, "viewfs://warcs/w/a")
    got = {r.page_id: r.payload for r in W.read_named(archives, "viewfs://warcs/w/a").collect()}
    assert got == {k: html.encode() for k, _, html in pages}
    files = [f.read_bytes() for f in (tmp_path / "store" / "a").glob("part-*") if f.stat().st_size]
    assert len(files) == archives.count() > 2
    assert all(f[:4] == b"\x5d\x2a\x4d\x18" and f.endswith(W.END_FRAME.encode()) for f in files)
    assert sum(len(list(W.read_archive(f))) for f in files) == 160


def test_no_pages_give_no_archives(spark, tmp_path):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    archives = W.write_archives(none, f"file://{tmp_path}/a")
    assert archives.count() == 0 and W.read_named(archives, f"file://{tmp_path}/a").count() == 0

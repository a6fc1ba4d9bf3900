import numpy as np
import pytest
from pyarrow import fs as pafs

from lendscope.llm import common


@pytest.mark.parametrize(("uri", "path"), [("/a/b", "/a/b"), ("file:/a/b", "/a/b"), ("file:///a/b", "/a/b"),
                                           ("dbfs:/a/b", "/dbfs/a/b"), ("a/b:c", "a/b:c")])
def test_names_of_local_folders(uri, path):
    fs, found = common._open(uri)
    assert isinstance(fs, pafs.LocalFileSystem) and found == path


@pytest.mark.parametrize(("uri", "asked"), [("s3a://b/k", "s3://b/k"), ("s3n://b/k", "s3://b/k"),
                                            ("gcs://b/k", "gs://b/k"), ("hdfs://h:1/k", "hdfs://h:1/k")])
def test_hadoop_schemes_are_named_as_arrow_does(uri, asked, monkeypatch):
    class Stores:
        LocalFileSystem = pafs.LocalFileSystem

        class FileSystem:
            from_uri = staticmethod(lambda u: ("store", u))
    monkeypatch.setattr(common, "pafs", Stores)
    assert common._open(uri) == ("store", asked)


def test_copies_are_kept_by_process_and_leave_no_files(tmp_path, monkeypatch):
    """A store without file paths: one copy a process, at most KEPT_COPIES, none with a name."""
    folder = tmp_path / "store"
    folder.mkdir()
    temp = tmp_path / "temp"
    temp.mkdir()
    for i in range(4):
        (folder / str(i)).write_bytes(b"" if i == 3 else bytes([i]) * 100)
    reads = []

    class Remote:
        def open_input_stream(self, path):
            reads.append(path)
            return pafs.LocalFileSystem().open_input_stream(path)
    monkeypatch.setattr(common, "_open", lambda uri: (Remote(), str(folder / uri.rpartition("/")[2])))
    monkeypatch.setattr(common.tempfile, "tempdir", str(temp))
    monkeypatch.setattr(common, "KEPT_COPIES", 2)
    common._copies().clear()
    for i in (0, 0, 1, 0, 2, 0, 1, 3):
        assert common.mapped(f"far://{i}").tolist() == ([] if i == 3 else [i] * 100)
    assert [r.rpartition("/")[2] for r in reads] == ["0", "1", "2", "1", "3"]
    assert len(common._copies()) == 2 and not list(temp.iterdir())
    common._copies().clear()


def test_put_file_is_whole_and_mapped_again(tmp_path):
    uri = f"file:{tmp_path}/a/b"
    common.put_file(uri, [np.arange(5, dtype=np.int64), b"xy"])
    raw = common.mapped(uri)
    assert raw[:40].view(np.int64).tolist() == list(range(5)) and bytes(raw[40:]) == b"xy"
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["b"]

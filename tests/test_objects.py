import hashlib

import pytest

from tallywell.sources.objects import fetch_objects, put_objects
from tallywell.storage import fresh_path


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_references(spark, scheme):
    root = f"{scheme}{fresh_path(spark, 'objects')}"
    contents = {f"{root}/a b/{i}%20.tif": bytes([i]) * (i * 1000) for i in range(40)}
    rows = spark.createDataFrame(list(contents.items()), "path string, content binary")
    assert put_objects(rows.repartition(4)) == 40
    assert put_objects(rows.limit(0)) == 0
    put_objects(rows.limit(5))  # written again: the same objects
    wanted = [*contents, *list(contents)[:10], f"{root}/gone", f"{root}/gone", f"{root}/a b", None]
    references = spark.createDataFrame([(i, p) for i, p in enumerate(wanted)], "id int, ref string")
    got = {r.path: r for r in fetch_objects(references, "ref", most_bytes=38_500).collect()}
    assert set(got) == set(wanted)
    for path, content in contents.items():
        r = got[path]
        if len(content) > 38_500:
            assert (r.length, r.content, r.reason) == (39_000, None, "too large")
        else:
            assert (r.length, hashlib.md5(r.content).digest(), r.reason) == (len(content), hashlib.md5(content).digest(), None)
    assert {p: got[p].reason for p in wanted[50:]} == {f"{root}/gone": "not found", f"{root}/a b": "not a file", None: "no path"}
    assert {p: r.n_references for p, r in got.items() if r.n_references > 1} == dict.fromkeys([*list(contents)[:10], f"{root}/gone"], 2)


def test_no_references_and_no_store(spark):
    assert fetch_objects(spark.createDataFrame([], "path string")).count() == 0
    with pytest.raises(Exception, match="nostore|scheme|URI"):
        fetch_objects(spark.createDataFrame([("nostore://x/y",)], "path string")).collect()

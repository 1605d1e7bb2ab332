import html
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from placeweave.operators import linkage, wiki
from placeweave.sources import files, wiki_xml
from placeweave.sources.schemas import ACTIVITY
from placeweave.sources.scratch import scratch_path
from placeweave.streaming.ingest import extract_new_chunks

XML = """<mediawiki><siteinfo><x/></siteinfo>
<page><title>Prado {n}</title><revision><text bytes="9" xml:space="preserve">{{{{Infobox museum
| location = [[Madrid]]
}}}}
[[Category:Museums in Madrid]]</text></revision></page>
<page><title>No text {n}</title><revision><id>1</id></revision></page>
<page><title>Redirect</title><revision><text>#REDIRECT [[Prado]]</text></revision></page>
</mediawiki>"""


def test_dictionary(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(["from hanoi", "hanoi", "kraków"], indent=1), encoding="utf-8")
    got = files.read_dictionary(spark, str(tmp_path / "d.json")).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, "from hanoi"), (1, "hanoi"), (2, "kraków")]
    assert files.read_dictionary(spark, str(tmp_path / "missing.json")).count() == 0


def test_records(spark, tmp_path):
    lines = [json.dumps({"url": "u1", "name": "Müller", "rating": 4.5, "reviewCount": "3,400"}), json.dumps({"url": "u2", "rating": "4,5"}), "{broken"]
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    path = str(tmp_path / "a.jsonl")
    good = files.good_records(files.read_jsonl(spark, path, ACTIVITY)).orderBy("url").collect()
    assert [(r.url, r.rating) for r in good] == [("u1", "4.5"), ("u2", "4,5")]
    assert [r.value for r in files.bad_records(spark, path, ACTIVITY).collect()] == ["{broken"]
    out = str(tmp_path / "out")
    files.write_jsonl(spark.createDataFrame([("é", None)], "a string, b string"), out)
    assert spark.read.text(out).first().value == '{"a":"é","b":null}'


def test_missing_city_pages(spark, tmp_path):
    assert files.read_optional_jsonl(spark, str(tmp_path / "none.jsonl"), ACTIVITY) is None
    landmarks = spark.createDataFrame([("a", "x")], "title string, type string")
    assert linkage.union_pages(landmarks, None).count() == 1
    both = linkage.union_pages(landmarks, spark.createDataFrame([("b",)], "title string"))
    assert {tuple(r) for r in both.collect()} == {("a", "x"), ("b", None)}


def test_html_files(spark, tmp_path):
    (tmp_path / "rome").mkdir()
    (tmp_path / "rome" / "rome_0.html").write_text("<h1>A\nB</h1>")
    df = files.read_html_files(spark, str(tmp_path / "*"))
    row = df.withColumn("city", files.city_from_path(df["path"])).first()
    assert row.html == "<h1>A\nB</h1>" and row.city == "rome"


def test_f27_texts_are_written_to_folders(spark, tmp_path):
    """Every text is in its folder, whole, and nothing is left behind."""
    path = str(tmp_path / "saved")
    rows = spark.range(40).selectExpr("id AS k", "concat('<p>', id, char(10), '</p>') AS value")
    files.write_text_files(rows, "k", path)
    tasks = {f.name.split("-")[1] for f in (tmp_path / "saved").glob("k=*/part-*")}
    assert len(tasks) > 8  # so few bytes went to one task before
    saved = files.read_html_files(spark, f"{path}/*").withColumn("folder", files.city_from_path(F.col("path")))
    assert {r.folder: r.html for r in saved.collect()} == {f"k={k}": f"<p>{k}\n</p>\n" for k in range(40)}


def test_f1_folders_are_those_of_spark(spark, tmp_path):
    """Odd names, none, and several rows of a folder; files hold what Spark's own writer puts there, and no process sets their modes."""
    odd = ["a", "a", "", None, "x/y", "50%", "a b", "é=1", "q?[z]^{u}", "it's", 'say "hi"', "tab\there", "back\\slash", "#*:", ".."]
    rows = spark.createDataFrame([(k, f"text {i} é" if i != 6 else None) for i, k in enumerate(odd)], "`k=` string, value string")
    files.write_text_files(rows, "k=", f"file://{tmp_path}/mine")
    rows.repartition(3, "k=").write.partitionBy("k=").text(str(tmp_path / "sparks"))

    def saved(root):
        found = {}
        for f in sorted(root.rglob("part-*")):
            found.setdefault(str(f.parent.relative_to(root)), []).extend(f.read_bytes().split(b"\n"))
        return {k: sorted(v) for k, v in found.items()}

    assert saved(tmp_path / "mine") == saved(tmp_path / "sparks")
    assert not [*(tmp_path / "mine").rglob("*.crc")] and (tmp_path / "mine" / "_SUCCESS").exists()  # Hadoop's local file system wrote those
    with pytest.raises(FileExistsError):
        files.write_text_files(rows, "k=", str(tmp_path / "mine"))
    files.write_text_files(rows.limit(0), "k=", str(tmp_path / "none"))
    assert [f.name for f in (tmp_path / "none").iterdir()] == ["_SUCCESS"]
    bad = rows.withColumn("value", F.expr("if(value IS NULL, raise_error('no'), value)"))
    with pytest.raises(Exception, match="no"):
        files.write_text_files(bad, "k=", str(tmp_path / "failed"))
    assert sorted(f.name for f in tmp_path.iterdir()) == ["mine", "none", "sparks"]


def test_f1_folders_are_listed_by_few_tasks(spark, tmp_path):
    files.write_text_files(spark.range(300).selectExpr("id AS k", "'x' AS value"), "k", str(tmp_path / "saved"))
    before, tracker = spark.conf.get(files.LISTING), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("f1-listing", "")
    try:
        found = files.read_html_files(spark, f"{tmp_path}/saved/*")
        stages = [s for j in tracker.getJobIdsForGroup("f1-listing") for s in tracker.getJobInfo(j).stageIds]
        tasks = sum(tracker.getStageInfo(s).numTasks for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < tasks <= 8 * spark.sparkContext.defaultParallelism < 300  # one for each folder before
    assert spark.conf.get(files.LISTING) == before and found.count() == 300


def test_chunks_are_extracted_once(spark, tmp_path):
    chunks, out, check = (str(tmp_path / d) for d in ("chunks", "out", "check"))
    (tmp_path / "chunks").mkdir()
    for n in (1, 2):
        (tmp_path / "chunks" / f"c{n}.xml").write_text(XML.format(n=n))
        extract_new_chunks(spark, chunks, out, check).awaitTermination()
        assert spark.read.json(out).count() == n
    # A chunk without a record is done as well.
    (tmp_path / "chunks" / "c3.xml").write_text("<mediawiki><page><title>x</title><revision><text>none</text></revision></page></mediawiki>")
    extract_new_chunks(spark, chunks, out, check).awaitTermination()
    query = extract_new_chunks(spark, chunks, out, check)
    query.awaitTermination()
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    assert sorted(r.title for r in spark.read.json(out).collect()) == ["Prado 1", "Prado 2"]


def test_one_dump_file_is_read_by_several_tasks(spark, tmp_path):
    texts = [f"line {n}\n\n&lt;page&gt; é {'x' * (n % 97)}\n&lt;/page&gt; end" for n in range(500)]
    pages = "\n".join(f'  <page>\n    <title>T {n}</title>\n    <revision>\n      <text xml:space="preserve">{t}</text>\n    </revision>\n  </page>' for n, t in enumerate(texts))
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "d.xml").write_text(f"<mediawiki>\n{pages}\n</mediawiki>\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = wiki_xml.read_pages(spark, str(tmp_path / "dump"))
        tasks = {r[0] for r in read.select(F.spark_partition_id()).distinct().collect()}
        got = {r.title: r.text for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(tasks) > 10
    assert got == {f"T {n}": html.unescape(t) for n, t in enumerate(texts)}


@pytest.mark.parametrize("master", ["spark://far:7077", "local-cluster[3,2,1024]", "yarn"])
def test_scratch_needs_a_shared_folder_on_a_cluster(master):
    def session(**settings):  # a stand-in: the settings of a real one may name a folder
        return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master, applicationId="a"))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session(), "x")
    assert scratch_path(session(**{"spark.checkpoint.dir": "hdfs://n/shared/"}), "x").startswith("hdfs://n/shared/x-")


def test_scan_is_counted_on_the_way(spark, tmp_path):
    (tmp_path / "c.xml").write_text(XML.format(n=1))
    scanned, kept = Observation("scanned"), Observation("kept")
    pages = wiki.observe_scan(wiki_xml.read_pages(spark, str(tmp_path / "c.xml")), scanned)
    records = wiki.page_records(pages, observation=kept).collect()
    assert records[0].fields.location == "Madrid" and records[0].geo_parent == ["Madrid"]
    assert scanned.get["pages_scanned"] == 2 and kept.get["records_kept"] == 1

"""Archives that are the caller's, and headers of any length."""

import os
import subprocess
import sys

from tidemill.llm import warc


def test_a_header_of_any_length_is_read(spark):
    url = "http://x/" + "u" * 3_500_000
    pages = spark.createDataFrame([(1, url, "one"), (2, "http://y/", "two"), (3, url, "one")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["payload_bytes"], r["refers_to"]) for r in warc.records(warc.archive_pages(pages)).collect()}
    assert got == {1: ("response", 3, None), 2: ("response", 3, None), 3: ("revisit", 3, 1)}


def test_a_given_folder_outlives_the_session(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from tidemill.llm import warc
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
pages = s.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
print(warc.archive_pages(pages, folder="file://{tmp_path}/arch").count(), warc.archive_pages(pages).first()["file"])
s.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": root})
    assert said.returncode == 0, said.stderr
    assert [f for f in os.listdir(tmp_path / "arch") if f.endswith(".warc.gz")]
    own = said.stdout.split()[-1].removeprefix("file://")
    assert own.endswith(".warc.gz") and not os.path.exists(own)

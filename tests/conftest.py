import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from tests.pages import DICTIONARY_PAGE


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("codedframes-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="codedframes-checkpoint-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="codedframes-test-")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.createDataFrame([("d1", DICTIONARY_PAGE)], "dict_id string, html string")


@pytest.fixture(scope="session")
def dictionary_file():
    path = os.path.join(tempfile.mkdtemp(prefix="codedframes-dictionary-"), "dictionary.html")
    with open(path, "w", encoding="utf-8") as out:
        out.write(DICTIONARY_PAGE)
    return path


@pytest.fixture(scope="session")
def dictionary(pages):
    from codedframes.sources.dictionary import parse_dictionary

    return parse_dictionary(pages).cache()


@pytest.fixture(scope="session")
def encodings(pages, dictionary):
    from codedframes.sources.codings import route_encodings
    from codedframes.sources.dictionary import parse_encodings

    page = parse_encodings(pages)
    files = pages.sparkSession.createDataFrame(
        [("77", 1, "-1", "Upper limbs", "0", "N"), ("77", 2, "501", "Hand", "1", "Y"),
         ("77", 3, "-1", "Lower limbs", "0", "N"), ("77", 4, "502", "Foot", "3", "Y")],
        "encoding_id string, pos bigint, code string, meaning string, parent_id string, selectable string",
    )
    return route_encodings(dictionary, page, files).cache()

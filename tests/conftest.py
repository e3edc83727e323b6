import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from careweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("careweave-tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


MESSAGES = "tweet_id string, author_id string, in_reply_to_tweet_id string, created_at string, text string"


@pytest.fixture(scope="session")
def messages(spark):
    """Two usable threads, plus every way a reply can fail to become a pair."""
    return spark.createDataFrame([
        ("1", "ana", "", "01", "@Shop my parcel is late, see https://x.io/a"),
        ("2", "Shop", "1", "02", "@ana sorry to hear that"),
        ("3", "Shop", "1", "03", "we will look into it"),
        ("4", "bo", "", "04", "too short"),
        ("5", "Shop", "4", "05", "please send the details"),
        ("6", "cy", "", "06", "@Shop"),
        ("7", "Shop", "6", "07", "how can we help"),
        ("8", "Shop", "99", "08", "parent is not here"),
        ("9", "SHOP", "2", "09", "reply to the brand itself"),
        ("10", "di", "", "10", "  MY parcel is late, see www.y.com  "),
        ("11", "shop", "10", "11", "@di sorry to hear that"),
        ("12", "eve", "", "12", "   "),
        ("13", "Shop", "", "13", "not a reply at all"),
    ], MESSAGES)

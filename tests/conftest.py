import datetime as dt
import json

import pytest

from starbrook.schemas import EVENT_SCHEMA, IP_RANGE_SCHEMA
from starbrook.session import build_session
from starbrook.sources.warehouse import Warehouse
from starbrook.streaming.ingest import Ingest

CHROME = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/91.0.4472.124 Safari/537.36"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ranges(spark):
    rows = [
        (16777216, 16777471, "US", "United States", "California", "San Jose"),
        (16777472, 16842751, "VN", "Vietnam", "Hanoi", "Hanoi"),
        (33554432, 50331647, "FR", "France", None, "Paris"),
    ]
    return spark.createDataFrame(rows, IP_RANGE_SCHEMA)


def millis(text: str) -> int:
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def event(**values):
    """One event with sensible defaults."""
    base = {
        "id": "e1",
        "collection": "view_product_detail",
        "current_url": "https://shop.test/p/1",
        "device_id": "cookie1",
        "user_id_db": "u1",
        "resolution": "1920x1080",
        "email_address": "a@mail.test",
        "ip": "1.0.0.7",
        "product_id": "p1",
        "referrer_url": "https://ref.test/",
        "store_id": "s1",
        "time_stamp": millis("2024-01-05T10:00:00"),
        "user_agent": CHROME,
    }
    base.update(values)
    return base


@pytest.fixture()
def frame(frame_of):
    return frame_of


@pytest.fixture(scope="session")
def frame_of(spark):
    """Events from dictionaries, in the wire format's columns."""

    def build(*events):
        names = EVENT_SCHEMA.fieldNames()
        return spark.createDataFrame([tuple(e.get(n) for n in names) for e in events], EVENT_SCHEMA)

    return build


@pytest.fixture()
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture()
def ingest(warehouse, ranges):
    return Ingest(warehouse, ranges)


@pytest.fixture()
def messages(spark):
    """Message values from texts or dictionaries."""

    def build(*values):
        texts = [v if isinstance(v, str) or v is None else json.dumps(v) for v in values]
        return spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(
            "cast(null as binary) as key",
            "cast(text as binary) as value",
            "cast(null as array<struct<key:string,value:binary>>) as headers",
        )

    return build


def rows(df, *order):
    """Sorted tuples of a frame."""
    found = [tuple(r) for r in df.select(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))

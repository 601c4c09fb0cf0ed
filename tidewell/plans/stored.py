"""The star, computed once from the source tables and kept as Parquet.

Reports and metrics read stored tables, as they would in production, so that each
of them scans only its columns instead of rebuilding the layers below. A table is
made when a query first asks for it, so a query pays for no table that it does not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.lexicon import Lexicon
from tidewell.operators.clean import clean_customers, clean_services, latest_bookings, valid_bookings
from tidewell.operators.dims import merge_customers, merge_services
from tidewell.operators.marts import build_fact_booking, daily_service_kpi
from tidewell.operators.reviews import backfill_reviews
from tidewell.operators.scoring import lexicon_scorer
from tidewell.operators.scd2 import scd2_history
from tidewell.session import configure, shared_dir
from tidewell.sources import star

# Words that mark a text of the given documents as negative, and
# everyday words that stand for themes in them.
DOCUMENT_LEXICON = Lexicon(
    positive={},
    negative={w: 1 for w in ("trash", "pathetic", "idiot", "worthless", "disgusting",
                             "stupid", "clown", "scum", "loser", "moron")},
    themes={"Punctuality": ["the", "an"], "Pricing": ["of", "to"], "Communication": ["in", "is", "it"]},
)

SOURCES = ("orders", "lineitem", "customer", "nation", "region", "supplier", "part", "events", "documents")

_written: dict[tuple[str, str, str], Star] = {}


#: Stored tables that are joined by a key more than once: their rows lie in buckets by it, so they are not dealt out for that.
BUCKETED = {"latest": "booking_id", "bookings": "booking_id"}


def _named(path: str) -> str:
    return f"tidewell_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def write(df: DataFrame, path: str, by: str | None = None) -> None:
    """Kept as Parquet; with `by`, in as many buckets by that column as shuffles have parts, for `read` to know of."""
    kept = lambda rows: rows.write.mode("overwrite").option("compression", "zstd")
    if by is None:
        kept(df).parquet(path)
    else:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # A file for each bucket; Spark deals out nothing where the rows lie like that already.
        kept(df.repartition(parts, by)).format("parquet").bucketBy(parts, by).option("path", path).saveAsTable(_named(path))


def read(spark: SparkSession, path: str, by: str | None = None) -> DataFrame:
    return spark.read.parquet(path) if by is None else spark.table(_named(path))


def source_mark(spark: SparkSession, sf_dir: str) -> str:
    """Tells apart the states of the source tables, by their files' names, sizes and times."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load([f"{sf_dir}/{t}.parquet" for t in SOURCES])
    mark = F.sum(F.xxhash64("path", "length", F.col("modificationTime").cast("string")).cast("decimal(38,0)"))
    return str(files.agg(mark).first()[0])


def silver_bookings(spark: SparkSession, sf_dir: str, reviews: bool = True) -> DataFrame:
    """Latest valid bookings. They are ranked without their texts, which only the winners fetch afterwards."""
    latest = latest_bookings(valid_bookings(star.typed_bookings(spark, sf_dir, reviews=False)))
    return star.with_review_texts(spark, sf_dir, latest) if reviews else latest


class Star(Mapping[str, DataFrame]):
    """The stored tables by name; each is built and written when it is first asked for, after those it is made of."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self.spark, self.sf_dir, self.root, self.written = spark, sf_dir, root, set()
        self.builds: dict[str, Callable[[], DataFrame]] = {
            "raw": lambda: star.raw_bookings(spark, sf_dir),
            "latest": lambda: silver_bookings(spark, sf_dir),
            "customers": lambda: merge_customers(None, clean_customers(star.raw_customers(spark, sf_dir))),
            "services": lambda: merge_services(None, clean_services(star.raw_services(spark, sf_dir))),
            "providers": lambda: scd2_history(star.provider_events(spark, sf_dir)),
            "dates": lambda: star.calendar(spark, sf_dir),
            "bookings": lambda: build_fact_booking(self["latest"], self["customers"], self["services"], self["providers"], stored=True),
            "reviews": lambda: backfill_reviews(None, self["latest"], lexicon_scorer(DOCUMENT_LEXICON), "LEXICON", limit=None),
            "kpi": lambda: daily_service_kpi(self["bookings"], self["dates"], self["services"], self["reviews"]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if name not in self.written:
            write(self.builds[name](), path, BUCKETED.get(name))
            self.written.add(name)
        return read(self.spark, path, BUCKETED.get(name))

    def __iter__(self) -> Iterator[str]:
        return iter(self.builds)

    def __len__(self) -> int:
        return len(self.builds)


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """The stored tables of this application, made anew when a source has changed."""
    configure(spark)
    app = spark.sparkContext.applicationId
    state = (app, sf_dir, source_mark(spark, sf_dir))
    if state not in _written:
        mark = hashlib.sha256("|".join(state).encode()).hexdigest()[:12]
        _written[state] = Star(spark, sf_dir, f"{shared_dir(spark)}/tidewell-{app}/{mark}")
    return _written[state]

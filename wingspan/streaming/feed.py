"""Scheme deliveries as a stream (C10 driven by Structured Streaming).

The source loads one scheme after another ("repeat for all datasets"). Here
each delivery is a small request record (scheme parameters and the folders
of its staged site, visit and count tables) dropped into a request folder.
A file-source stream picks requests up and ``foreachBatch`` loads the
schemes of each micro-batch in ONE job and replaces them in the store; several
requests for one scheme are loaded one after the other, in the order of their
file names. The stream's checkpoint (in the shared folder) records which requests
were processed. Every load commits the number of its delivery (micro-batch and
round) together with its rows, so a batch that runs again after a failure skips
what it had already loaded, and no request is dropped or loaded twice.

Only the request rows (a few per scheme) reach the driver; the survey data
stays in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wingspan.plans import load as L
from wingspan.plans.publish import Store
from wingspan.session import scratch_scope
from wingspan.sources.readers import Scheme, scheme_detail

#: Delivery numbers of a micro-batch: a bound on one scheme's requests in it.
ROUNDS = 1_000_000
REQUEST_SCHEMA = ("bms_id string, country_iso3 string, country_name string, contact_name string, "
                  "contact_email string, sites string, visits string, counts string")


def _read_staged(spark: SparkSession, paths: list[str], scheme_ids: list[str]) -> DataFrame:
    frames = [spark.read.parquet(p).withColumn("bms_id", F.lit(b)) for p, b in zip(paths, scheme_ids)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_requests(spark: SparkSession, store: Store, requests: list[dict], checklist: DataFrame | None = None,
                  sources: dict[str, int] | None = None) -> str:
    """Load every requested scheme in one job and replace them in the store. ``sources``
    are delivery numbers to commit with the load."""
    ids = [r["bms_id"] for r in requests]
    detail = scheme_detail(spark, [Scheme(r["bms_id"], r["country_iso3"], r["country_name"], r["contact_name"],
                                          r["contact_email"]) for r in requests])
    sites = _read_staged(spark, [r["sites"] for r in requests], ids)
    visits = L.clean_visits(_read_staged(spark, [r["visits"] for r in requests], ids))
    counts = _read_staged(spark, [r["counts"] for r in requests], ids)
    if checklist is not None:
        counts = L.resolve_species(counts, checklist)
    marks = {t: store.high_water(t) for t in ("m_site", "b_recorder", "m_visit", "b_count")}
    with scratch_scope(spark):  # numbering copies are removed once published (or refused)
        tables = L.load_tables(detail, L.SchemeSources(sites, visits, counts), starts=marks)
        return store.replace_schemes(ids, tables, trusted_keys=True, sources=sources)


def rounds(requests: list[dict]) -> list[list[dict]]:
    """The requests in order, as rounds that name a scheme at most once: the n-th request
    of a scheme is in the n-th round."""
    out: list[list[dict]] = []
    seen: dict[str, int] = {}
    for r in requests:
        n = seen[r["bms_id"]] = seen.get(r["bms_id"], -1) + 1
        if n == len(out):
            out.append([])
        out[n].append(r)
    return out


def load_batch(spark: SparkSession, store: Store, requests: list[dict], checklist: DataFrame | None, stream: str, epoch: int) -> int:
    """Load a micro-batch of ``stream``, but for rounds that it committed before; the number of loads."""
    done = 0
    for n, some in enumerate(rounds(requests)):
        delivery = epoch * ROUNDS + n
        if delivery > store.log.state().sources.get(stream, -1):
            load_requests(spark, store, some, checklist, {stream: delivery})
            done += 1
    return done


def start_feed(spark: SparkSession, request_dir: str, store: Store, checkpoint: str,
               checklist: DataFrame | None = None, available_now: bool = False,
               max_files: int = 64) -> StreamingQuery:
    """Start the delivery stream: JSON request files in ``request_dir``."""
    # at most max_files request files per micro-batch: the driver holds a bounded list
    requests = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files).json(request_dir)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        # by file name (name deliveries by time, e.g. 2024-06-01T10-00_UK.json), then as the file lists them
        ordered = batch.select("*", F.input_file_name().alias("__file"), F.monotonically_increasing_id().alias("__line")).orderBy("__file", "__line")
        load_batch(batch.sparkSession, store, [r.asDict() for r in ordered.drop("__file", "__line").collect()], checklist, checkpoint, epoch)

    writer = requests.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

"""Continuous reconcile and delete with keyed state.

Everything about one object lives under its URI: the job of each version, the
newest event that had to wait, and the lease of a delete that is under way. A
waiting event is tried again when a worker result or the end of a delete
arrives, or a lease runs out, in place of being delivered again. The state of an
object can begin with its jobs in a stored job table.
"""

import json
from typing import NamedTuple

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from auditloom import fixed
from auditloom.sources.tables import write_batch

DECISION = (
    "gcs_uri string, prompt_version_id string, kind string, generation bigint, "
    "outcome string, delete_superseded_rows boolean, status string, attempts int, "
    "error_message string, decided bigint"
)
# No generation travels as 0, so that 64-bit values stay exact in pandas.
NONE = 0
MINUTE = 60_000
#: The time of a state that has none: its lease does not run out.
ALWAYS = 2**62

# Outcomes beside those of arrivals and delete plans.
LEASED, PURGED, RESTORED, RECORDED, UNKNOWN = "lease", "purged", "restored", "recorded", "unknown"


class Job(NamedTuple):
    """State of one job: `since` is when the status was entered, in ms."""

    status: str
    generation: int
    since: int
    attempts: int


def lease(job):
    """How long a job in this state keeps others waiting, in ms; 0 if not at all."""
    if job.status in (fixed.QUEUED, fixed.PROCESSING):
        return 120 * MINUTE
    if job.status == fixed.DELETING:
        return 10 * MINUTE
    failed = job.status in (fixed.FAILED_RETRY, fixed.FAILED_PERMANENT)
    return 10 * MINUTE if failed and 1 <= job.attempts < fixed.MAX_ATTEMPTS else 0


def busy(job, now):
    held = lease(job)
    return held > 0 and now - job.since <= held


def decide(job, generation, now):
    """(outcome, delete_superseded_rows) of an arriving object for one job."""
    if job is None:
        return fixed.OUTCOME_QUEUED, False
    held = busy(job, now)
    if generation == NONE or generation == job.generation:
        leased = held and job.status == fixed.DELETING
        if leased and generation == NONE:
            return fixed.OUTCOME_DEFERRED, False
        done = held or job.status == fixed.PROCESSED
        return (fixed.OUTCOME_SKIPPED if done else fixed.OUTCOME_QUEUED), False
    if generation < job.generation:
        return fixed.OUTCOME_SKIPPED, False
    return (fixed.OUTCOME_DEFERRED, False) if held else (fixed.OUTCOME_QUEUED, True)


class Held:
    """A map state of one object, read at its first use and written back by `store`.

    Each call to the state is a round trip between processes, so the rows of an
    object share one reading and one writing, however many they are.
    """

    def __init__(self, state):
        self._state, self._before, self._now = state, None, None

    def load(self):
        if self._now is None:
            self._before = {tuple(key): tuple(value) for key, value in self._state.iterator()}
            self._now = dict(self._before)
        return self._now

    def iterator(self):
        return iter(list(self.load().items()))

    def containsKey(self, key):
        return key in self.load()

    def getValue(self, key):
        return self.load()[key]

    def updateValue(self, key, value):
        self.load()[key] = tuple(value)

    def removeKey(self, key):
        self.load().pop(key, None)

    def clear(self):
        self.load().clear()

    def store(self):
        """Write what differs, and be ready for the next object."""
        if self._now is not None:
            for key in self._before:
                if key not in self._now:
                    self._state.removeKey(key)
            for key, value in self._now.items():
                if self._before.get(key) != value:
                    self._state.updateValue(key, value)
        self._before = self._now = None


class ObjectProcessor(StatefulProcessor):
    """Jobs of one object, driven by arrivals, deletes, worker results and ends of deletes.

    `settled` treats a queued job as finished at once; replays use it. With
    `leased` a delete takes two steps: it marks the jobs DELETING and waits for
    a `deleted` or `restored` event that names this lease; without, the jobs go
    at once.
    """

    def __init__(self, versions, settled=False, leased=False):
        self._versions = list(versions)
        self._settled = settled
        self._leased = leased

    def init(self, handle):
        self._handle = handle
        self._jobs = Held(handle.getMapState(
            "jobs", "prompt_version_id string",
            "status string, generation bigint, since bigint, attempts int",
        ))
        # Per kind: the newest waiting generation, and whether one without any waits.
        self._waiting = Held(handle.getMapState("waiting", "kind string", "generation bigint, without boolean"))
        # The delete under way, and what its jobs were before.
        self._lease = Held(handle.getMapState("lease", "kind string", "generation bigint, since bigint"))
        self._before = Held(handle.getMapState("before", "prompt_version_id string", "status string, since bigint"))
        # Whether the stored jobs of the object have been taken over.
        self._begun = Held(handle.getMapState("begun", "kind string", "jobs int"))

    def _store(self):
        for state in (self._jobs, self._waiting, self._lease, self._before, self._begun):
            state.store()

    def handleInitialState(self, key, initialState, timerValues):
        for row in initialState.itertuples(index=False):
            self._jobs.updateValue(
                (row.prompt_version_id,), (row.status, int(row.generation), int(row.since), int(row.attempts))
            )
        self._store()

    def _begin(self, stored):
        """Take over the stored jobs of an object that is met for the first time."""
        if self._begun.containsKey(("jobs",)):
            return
        jobs = json.loads(stored)
        for version, status, generation, since, attempts in jobs:
            self._jobs.updateValue((version,), (status, int(generation), int(since), int(attempts)))
        self._begun.updateValue(("jobs",), (len(jobs),))

    def _all_jobs(self):
        return {key[0]: Job(*value) for key, value in self._jobs.iterator()}

    def _lease_held(self, now):
        """The lease of a delete that has not run out."""
        if not self._lease.containsKey(("delete",)):
            return None
        generation, since = self._lease.getValue(("delete",))
        return (generation, since) if now - since <= 10 * MINUTE else None

    def _wait(self, kind, generation, now, jobs):
        known, without = NONE, False
        if self._waiting.containsKey((kind,)):
            known, without = self._waiting.getValue((kind,))
        self._waiting.updateValue((kind,), (max(known, generation), without or generation == NONE))
        ends = [j.since + lease(j) + 1 for j in jobs.values() if busy(j, now) and j.since != ALWAYS]
        held = self._lease_held(now)
        if held is not None:
            ends.append(held[1] + 10 * MINUTE + 1)
        if ends:
            self._handle.registerTimer(max(min(ends), now + 1))

    def _say(self, out, version, kind, generation, outcome, superseded=False, status=None, attempts=0, error=None):
        out.append((version, kind, generation, outcome, superseded, status, attempts, error))

    def _arrive(self, generation, now, out):
        jobs, deferred = self._all_jobs(), False
        for version in self._versions:
            outcome, superseded = decide(jobs.get(version), generation, now)
            if outcome == fixed.OUTCOME_QUEUED:
                status = fixed.PROCESSED if self._settled else fixed.QUEUED
                self._jobs.updateValue((version,), (status, generation, now, 0))
            deferred = deferred or outcome == fixed.OUTCOME_DEFERRED
            self._say(out, version, "finalize", generation, outcome, superseded)
        if deferred:
            self._wait("finalize", generation, now, jobs)

    def _delete(self, generation, now, out):
        jobs = self._all_jobs()
        newest = max((j.generation for j in jobs.values()), default=NONE)
        if NONE < generation < newest:
            action = fixed.ACTION_SKIP
        elif self._lease_held(now) is not None or any(busy(j, now) for j in jobs.values()):
            action = fixed.ACTION_DEFER
            self._wait("delete", generation, now, jobs)
        elif self._leased:
            action = LEASED
            for version, job in jobs.items():
                if job.status != fixed.DELETING:
                    self._before.updateValue((version,), (job.status, job.since))
                self._jobs.updateValue((version,), (fixed.DELETING, job.generation, now, job.attempts))
            self._lease.updateValue(("delete",), (generation, now))
            self._handle.registerTimer(now + 10 * MINUTE + 1)
        else:
            action = fixed.ACTION_DELETE
            self._jobs.clear()
        self._say(out, None, "delete", generation, action)

    def _end(self, row, now, out):
        """The second step of the delete whose lease the event names; others are ignored."""
        if not self._lease.containsKey(("delete",)):
            return
        generation, since = self._lease.getValue(("delete",))
        if row.status != str(since):
            return
        for version, job in self._all_jobs().items():
            if job.status != fixed.DELETING or job.since != since:
                continue  # taken over since
            if row.kind == "deleted":
                self._jobs.removeKey((version,))
                self._say(out, version, "delete", generation, PURGED)
            else:
                known = self._before.containsKey((version,))
                status, start = self._before.getValue((version,)) if known else (fixed.DELETING, 0)
                self._jobs.updateValue((version,), (status, job.generation, start, job.attempts))
                self._say(out, version, "delete", generation, RESTORED, status=status)
        self._lease.clear()
        self._before.clear()
        action = fixed.ACTION_DELETE if row.kind == "deleted" else fixed.ACTION_SKIP
        self._say(out, None, "delete", generation, action)

    def _result(self, row, now, out):
        version, outcome = row.prompt_version_id, UNKNOWN
        if self._jobs.containsKey((version,)):
            old = Job(*self._jobs.getValue((version,)))
            # One for an object that is newer by now, or is being deleted, is of no use.
            if old.status != fixed.DELETING and (row.generation in (NONE, old.generation)):
                self._jobs.updateValue((version,), (row.status, old.generation, now, int(row.attempts)))
                outcome = RECORDED
        self._say(out, version, "result", row.generation, outcome, False, row.status, int(row.attempts), row.error_message)

    def _retry_waiting(self, now, out):
        waiting = {key[0]: value for key, value in self._waiting.iterator()}
        self._waiting.clear()
        if "finalize" in waiting:
            self._arrive(waiting["finalize"][0], now, out)
        if "delete" in waiting:
            # One without a generation is unconditional, whatever waits beside it.
            generation, without = waiting["delete"]
            self._delete(NONE if without else generation, now, out)

    @staticmethod
    def _frame(key, out, now):
        columns = ["prompt_version_id", "kind", "generation", "outcome", "delete_superseded_rows", "status", "attempts",
                   "error_message"]
        frame = pd.DataFrame(out, columns=columns)
        frame.insert(0, "gcs_uri", key[0])
        frame["decided"] = now
        return frame

    def handleInputRows(self, key, rows, timerValues):
        now, out = timerValues.getCurrentProcessingTimeInMs(), []
        arrivals, deletes, results, ends, stored = [], [], [], [], None
        for batch in rows:
            if "stored" in batch and stored is None:
                # All rows of an object carry the same.
                stored = batch["stored"].iloc[0]
            kinds, generations = batch["kind"], batch["generation"]
            arrivals += generations[kinds == "finalize"].tolist()
            deletes += generations[kinds == "delete"].tolist()
            others = batch[~kinds.isin(["finalize", "delete"])]
            for row in others.itertuples(index=False) if len(others) else ():
                (ends if row.kind in ("deleted", "restored") else results).append(row)
        if isinstance(stored, str):
            self._begin(stored)
        for row in results:
            self._result(row, now, out if self._leased else [])
        for row in ends:
            self._end(row, now, out)
        if results or ends:
            self._retry_waiting(now, out)
        # Newest first: what is older, or has no generation, is then covered.
        for generation in sorted(arrivals, reverse=True):
            self._arrive(int(generation), now, out)
        for generation in sorted(deletes, reverse=True):
            self._delete(int(generation), now, out)
        self._store()
        yield self._frame(key, out, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, out = timerValues.getCurrentProcessingTimeInMs(), []
        self._retry_waiting(now, out)
        self._store()
        yield self._frame(key, out, now)

    def close(self):
        pass


#: What the processor is fed: arrivals, deletes, worker results and ends of deletes.
INPUT = (
    "gcs_uri string, kind string, generation bigint, prompt_version_id string, "
    "status string, attempts int, error_message string"
)


def _shape(events):
    """The input columns of the processor; absent ones become NULL or 0."""
    have = set(events.columns)

    def col(name, kind, default):
        value = F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
        return F.coalesce(value, F.lit(default).cast(kind)).alias(name)

    return events.select(
        "gcs_uri",
        "kind",
        col("generation", "bigint", NONE),
        col("prompt_version_id", "string", ""),
        col("status", "string", ""),
        col("attempts", "int", 0),
        col("error_message", "string", ""),
    )


def seed(jobs):
    """The stored job table in the form of the processor's state."""
    entered = (
        F.when(F.col("status") == fixed.QUEUED, F.col("queued_at"))
        .when(F.col("status") == fixed.DELETING, F.col("deleting_at"))
        .otherwise(F.col("last_processed_at"))
    )
    holds = F.col("status").isin(fixed.QUEUED, fixed.PROCESSING, fixed.DELETING)
    since = F.coalesce(F.unix_millis(entered), F.when(holds, F.lit(ALWAYS)).otherwise(F.lit(0)))
    return jobs.select(
        "gcs_uri",
        "prompt_version_id",
        F.coalesce("status", F.lit("")).alias("status"),
        F.coalesce("generation", F.lit(NONE)).cast("bigint").alias("generation"),
        since.cast("bigint").alias("since"),
        F.coalesce("attempts", F.lit(0)).cast("int").alias("attempts"),
    )


def with_stored(events, jobs):
    """`events` with the stored jobs of their object as JSON in `stored`; NULL where there are none.

    An object has as many jobs as there are versions. Only objects that events
    name reach the processor, whatever the size of the job table.
    """
    one = F.array(*[F.col(c).cast("string") for c in ("prompt_version_id", "status", "generation", "since", "attempts")])
    known = jobs.select(F.col("gcs_uri").alias("_uri"), one.alias("one"))
    known = known.groupBy("_uri").agg(F.to_json(F.collect_list("one")).alias("stored"))
    return events.join(known, F.col("gcs_uri").eqNullSafe(F.col("_uri")), "left").drop("_uri")


def drop_repeats(events, time_col, delay="10 minutes"):
    """Drop repeated deliveries of the same (object, kind, generation).

    The key spreads a hot object over tasks by generation. Events without a
    generation pass, as two of them need not be the same.
    """
    key = F.coalesce(F.col("generation").cast("string"), F.expr("uuid()"))
    return (
        events.withWatermark(time_col, delay)
        .withColumn("_key", key)
        .dropDuplicatesWithinWatermark(["gcs_uri", "kind", "_key"])
        .drop("_key")
    )


def reconcile_stream(events, versions, settled=False, leased=False, jobs=None):
    """Decisions for a stream of events.

    `events` has gcs_uri, kind and generation; kind is 'finalize', 'delete',
    'result' (also with prompt_version_id, status, attempts and error_message)
    or, with `leased`, 'deleted' and 'restored' (with the lease as status). `jobs`
    is a job table to begin with, which must stay as it is as long as the checkpoint
    is used: an object takes its jobs from there when its first event arrives.
    A settled replay never waits, so it sets no timers and ends with its input;
    the live form keeps making batches to fire them.
    """
    mode = "None" if settled else "ProcessingTime"
    shaped = _shape(events)
    return (
        (shaped if jobs is None else with_stored(shaped, seed(jobs)))
        .groupBy("gcs_uri")
        .transformWithStateInPandas(ObjectProcessor(versions, settled, leased), DECISION, "Append", mode)
        .withColumn("generation", F.nullif("generation", F.lit(NONE)))
        .withColumn("error_message", F.nullif("error_message", F.lit("")))
        .withColumn("decided_at", F.timestamp_millis("decided"))
        .drop("decided")
    )


def start_decisions(decisions, path, checkpoint, trigger=None):
    """Write decisions as they are made."""
    return (
        decisions.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_latest(events, path, checkpoint, trigger=None):
    """Keep the newest generation per object, however late it arrives.

    A streaming maximum: partial sums are built before the shuffle and the
    state is one row per object. Each batch writes the objects that changed.
    """
    latest = (
        events.where("generation is not null")
        .groupBy("gcs_uri")
        .agg(F.max("generation").alias("generation"))
    )
    return (
        latest.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: write_batch(batch, path, number))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

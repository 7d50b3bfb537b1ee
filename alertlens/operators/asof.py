"""Effective preference (J1 + P19 + W1 = J3) without the many-to-many fan-out.

Meaning (record preset): for each decision, among the preferences with the same
(account, customer) key, take the latest one strictly before the decision time (flag 'Y');
if there is none, the latest one overall (flag 'N'); ties by preference event id.  A missing
preference time counts as "before" under ``nulls='low'`` but ranks last.  A decision with no
preference at all gets NULL preference columns and flag 'Y' (``nulls='low'``, time present).

One plan for every input size, with no action, broadcast hint or threshold:

1. Preferences are reduced to one per (key, instant), the best of that instant, and decisions
   to their distinct (key, instant).  Both are partial aggregates, so any number of rows that
   share an instant (or have no time) costs a row a task.  Only key, time and preference id
   travel from here on.
2. Time is cut into buckets of ``BUCKET`` (one hour) for every key.  The last preference of each
   (key, bucket) runs as a carry over the buckets of its key.
3. One window per (key, bucket) continues from its carry: a running maximum gives the last
   preference before each decision instant.  A task sees one hour of one key, however hot.
4. What was chosen (key, instant, preference id) is written where the caller allows it.  Then a bit filter over the chosen ids, of
   a fixed greatest size, is broadcast and tested by every row of the preference feed on its plain
   id column: the test sinks below the parsing of the payload document, so about as many
   documents are parsed, and payload rows shuffled, as decisions chose.  The exact join follows.
5. The chosen preferences' columns are joined to the decision instants, and those to the
   decisions.  Both sides of these joins are plain exchanges, so adaptive execution may split a
   key that many decisions share.

O(decisions + preferences); no (decision, preference) pair is formed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.functions.scalars import micros
from alertlens.options import RECORD, Options

FLAG = "dec_tm_ge_pref_tm"
BUCKET = 3_600_000_000  # microseconds
NO_TIME = -(2**63)  # a missing time as a join key
KEY = ["_k1", "_k2"]
#: The filter has at most this many words of 64 bits, a broadcast of at most 16 MB whatever the
#: number of ids; with more ids than a few tens of millions it lets more rows pass.
FILTER_WORDS = 1 << 20


def _text_key(c: Column) -> Column:
    """A text as a join key: NULL becomes a value of its own, so that equality is null-safe."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _keyed(df: DataFrame, account: str, customer: str, ts: str) -> DataFrame:
    return df.withColumns({
        "_k1": _text_key(F.col(account)), "_k2": _text_key(F.col(customer)),
        "_m": F.coalesce(micros(F.col(ts)), F.lit(NO_TIME)),
    })


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _struct_of(cols) -> Column:
    return F.expr("struct(" + ", ".join(_q(c) for c in cols) + ")")


def _usable(pref: DataFrame, opts: Options) -> DataFrame:
    if opts.null_keys == "drop":
        pref = pref.where(F.col("external_account_p").isNotNull() & F.col("cust_id_p").isNotNull())
    return pref


def maybe_among(rows: DataFrame, id_col: str, wanted: DataFrame, wanted_col: str) -> DataFrame:
    """The rows whose text id may be among the wanted ones (a NULL id is an id): every wanted row
    and few others.  One bit an id, set by its hash; only the word number and its bits travel."""
    bit = "pmod(xxhash64({0}), {1})"
    w, r = (bit.format(f"coalesce(concat('=', cast({_q(c)} as string)), '')", FILTER_WORDS * 64) for c in (wanted_col, id_col))
    words = wanted.selectExpr(f"{w} div 64 AS _w", f"shiftleft(1L, cast({w} % 64 AS int)) AS _b").groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    hit = (F.expr(f"{r} div 64") == F.col("_w")) & F.expr(f"(_b & shiftleft(1L, cast({r} % 64 AS int))) <> 0")
    return rows.join(F.broadcast(words), hit, "left_semi")


def chosen_at(instants: DataFrame, pref: DataFrame, opts: Options = RECORD) -> DataFrame:
    """(key, instant, prior, best) of the distinct decision instants; ``prior`` and ``best`` are
    (m, id) of a preference: the last one before the instant, and the key's last one overall.

    ``instants`` has the key and ``_m``; ``pref`` the key, ``_m`` and ``_id`` (text or NULL)."""
    # among preferences of one instant the smaller id wins; a NULL id first under the record's
    # null order, last under 'last'
    null_rank = F.col("_id").isNotNull() if opts.null_order == "sas" else F.col("_id").isNull()
    one = pref.groupBy(*KEY, "_m").agg(F.min(F.struct(null_rank.alias("n"), F.col("_id").alias("s"))).alias("_best"))
    one = one.select(*KEY, "_m", F.struct(F.col("_m").alias("m"), _text_key(F.col("_best.s")).alias("id")).alias("_p"))
    state = one.schema["_p"].dataType
    bucket = F.when(F.col("_m") != NO_TIME, F.expr(f"_m div {BUCKET}")).alias("_b")
    rows = one.select(*KEY, bucket, "_m", F.lit(1).alias("_tag"), "_p").unionByName(
        instants.select(*KEY, bucket, "_m", F.lit(0).alias("_tag"), F.lit(None).cast(state).alias("_p")))

    per = rows.groupBy(*KEY, "_b").agg(F.max("_p").alias("_p"))
    # a preference without a time is before every timed decision under 'low', never under 'false'
    before = F.col("_p") if opts.nulls == "low" else F.when(F.col("_b").isNotNull(), F.col("_p"))
    of_key = Window.partitionBy(*KEY)
    earlier = of_key.orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*KEY, "_b", F.lit(NO_TIME).cast("bigint").alias("_m"), F.lit(-1).alias("_tag"),
                       F.max(before).over(earlier).alias("_p"), F.max("_p").over(of_key).alias("_all"))

    rows = rows.withColumn("_all", F.lit(None).cast(state)).unionByName(carry)
    here = Window.partitionBy(*KEY, "_b")
    # the carry first, then a decision before the preferences of its own instant
    upto = here.orderBy(F.col("_tag") != -1, "_m", "_tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        *KEY, "_m", "_tag", F.max("_p").over(upto).alias("_prior"), F.max("_all").over(here).alias("_best")
    ).where(F.col("_tag") == 0).drop("_tag")


Step = Callable[[DataFrame], DataFrame]


def effective_preference(dec: DataFrame, pref: DataFrame, opts: Options = RECORD, write: Step | None = None,
                         rescan: Callable[[Step], DataFrame] | None = None) -> DataFrame:
    """J3.  ``dec`` must hold one row per decision (see ``dedup_decisions``); it is read twice
    (its instants, and the final join), so write it first if it is costly.  ``write`` (write a
    table and read it back) takes what was chosen; without it the whole step stays one lazy plan,
    whose payload join isn't pruned.  ``rescan`` scans the preferences anew with a filter on the
    envelope rows (their ``source_event_id``); without it ``pref`` itself is filtered."""
    dcols, pcols = dec.columns, pref.columns
    d = _keyed(dec, "account_id", "customer_id", "event_ts")
    pref = _usable(pref, opts)
    p = _keyed(pref, "external_account_p", "cust_id_p", "event_ts_p").withColumn("_id", F.col("source_event_id_p").cast("string"))

    at = chosen_at(d.select(*KEY, "_m").distinct(), p, opts).withColumn("_c", F.coalesce("_prior", "_best"))
    flag = F.when(F.col("_prior").isNotNull(), F.lit("Y"))
    if opts.nulls == "low":
        flag = flag.when(F.col("_best").isNull() & (F.col("_m") != NO_TIME), F.lit("Y"))
    at = at.select(*KEY, "_m", F.col("_c.m").alias("_cm"), F.col("_c.id").alias("_cid"), flag.otherwise(F.lit("N")).alias(FLAG))
    if write is not None:
        at = write(at)

    # columns of the chosen preferences; rows that repeat an id at one instant: the least of them
    picked = [*KEY, "_cm", "_cid"]
    ids = at.where("_cid is not null").select(F.when(F.col("_cid") != "", F.expr("substring(_cid, 2)")).alias("_sid"))
    if write is None:
        wanted = pref
    elif rescan is None:
        wanted = maybe_among(pref, "source_event_id_p", ids, "_sid")
    else:
        wanted = _usable(rescan(lambda env: maybe_among(env, "source_event_id", ids, "_sid")), opts).select(*pcols)
    full = _keyed(wanted, "external_account_p", "cust_id_p", "event_ts_p")
    full = full.select(*KEY, F.col("_m").alias("_cm"), _text_key(F.col("source_event_id_p").cast("string")).alias("_cid"),
                       _struct_of(pcols).alias("_pv"))
    full = full.withColumn("_rn", F.row_number().over(Window.partitionBy(*picked).orderBy("_pv"))).where("_rn = 1").drop("_rn")
    at = at.join(full, picked, "left").select(*KEY, "_m", "_pv", FLAG)
    out = d.join(at, [*KEY, "_m"], "left")
    return out.selectExpr(*[_q(c) for c in dcols], *[f"_pv.{_q(c)} AS {_q(c)}" for c in pcols], FLAG)


def fanout_size(dec: DataFrame, pref: DataFrame, opts: Options = RECORD) -> DataFrame:
    """Row count the many-to-many join (J1) would produce, per key, without forming a pair:
    decisions x max(preferences, 1).  Two aggregates and a join of one row per key."""
    d = dec.groupBy(F.col("account_id").alias("_k1"), F.col("customer_id").alias("_k2")).agg(
        F.count(F.lit(1)).alias("decisions"))
    p = pref
    if opts.null_keys == "drop":
        p = p.where(F.col("external_account_p").isNotNull() & F.col("cust_id_p").isNotNull())
    p = p.groupBy(F.col("external_account_p").alias("_k1"), F.col("cust_id_p").alias("_k2")).agg(
        F.count(F.lit(1)).alias("preferences"))
    if opts.null_keys == "drop":
        cond = (d["_k1"] == p["_k1"]) & (d["_k2"] == p["_k2"])
    else:
        cond = d["_k1"].eqNullSafe(p["_k1"]) & d["_k2"].eqNullSafe(p["_k2"])
    j = d.join(p, cond, "left").select(
        d["_k1"].alias("account_id"), d["_k2"].alias("customer_id"), "decisions",
        F.coalesce(F.col("preferences"), F.lit(0)).cast("long").alias("preferences"),
    )
    return j.withColumn("fanout_rows", F.col("decisions") * F.greatest(F.col("preferences"), F.lit(1)))

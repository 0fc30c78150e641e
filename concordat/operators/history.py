"""Whole histories as tables: ancestry by doubled steps, and every proof and case derived again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.operators.revisions import CORRECTED, LATE, OPEN, proof_id
from concordat.sources.scratch import deleted, written

ORPHAN, CYCLE = "ORPHAN", "CYCLE"


def ancestry(links: DataFrame) -> DataFrame:
    """id, root, depth (from 1) and fault of every row of links (id, prior).

    Every row points to its prior; in each round a row whose pointer has no root yet points on to where that
    points, so a round doubles the steps, and 20 rounds are a million generations. A row whose prior
    stands nowhere is an ORPHAN and, like a first one, the root of those below it. Once a round brings no row to
    a root, none is left that has one: the others stand on a CYCLE or below one, and have neither root nor
    depth. Null ids are left out, and an id that repeats counts once, by its least prior. Each round is a
    table that replaces the one before, and joins only rows that are still under way.
    """
    own = written(links.where("id IS NOT NULL").groupBy("id").agg(F.min("prior").alias("prior")), "links")
    named = own.select(F.col("id").alias("prior"), F.lit(True).alias("known"))
    first = F.col("prior").isNull() | F.col("known").isNull()
    # root: where the pointer stands once done; steps: how many generations it is above.
    start = own.join(named, "prior", "left").select("id", F.when(first, F.col("id")).otherwise(F.col("prior")).alias("root"), F.when(first, 0).otherwise(1).alias("steps"), first.alias("done"), (F.col("prior").isNotNull() & first).alias("orphan"))
    now = written(start, "ancestors")
    deleted(own)
    left = now.where("NOT done").count()
    while left:
        target = now.select(F.col("id").alias("at"), F.col("root").alias("on"), F.col("steps").alias("more"), F.col("done").alias("ended"))
        moved = now.where("NOT done").join(target, F.col("root") == F.col("at")).select("id", F.col("on").alias("root"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ended").alias("done"), "orphan")
        after = written(now.where("done").unionByName(moved), "ancestors")
        deleted(now)
        now, before, left = after, left, after.where("NOT done").count()
        if left == before:
            break
    none = lambda c: F.when(F.col("done"), c)
    return now.select("id", none(F.col("root")).alias("root"), none((F.col("steps") + 1).cast("int")).alias("depth"), F.when(~F.col("done"), CYCLE).when(F.col("orphan"), ORPHAN).alias("fault"))


def derived_cases(proofs: DataFrame, corrected: DataFrame | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """run, reconciliation_key, initial_exception_proof_id, case_revision, case_status, reason_codes of every case in
    every run, from proofs (with run) alone. corrected: run, reconciliation_key of accepted corrections. within: columns that
    the key determines, returned too; rows that are dealt by these stay where they are."""
    so_far = Window.partitionBy(*within, "reconciliation_key").orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    broken = lambda c: F.when(F.col("status") == "EXCEPTION", F.col(c))
    rows = proofs.withColumn("initial_exception_proof_id", F.first(broken("proof_id"), ignorenulls=True).over(so_far)).withColumn("had", F.last(broken("reason_codes"), ignorenulls=True).over(so_far))
    rows = rows.where("initial_exception_proof_id IS NOT NULL").withColumn("case_revision", F.count("*").over(so_far).cast("int"))
    mended = F.lit(False)
    if corrected is not None:
        rows = rows.join(corrected.select("run", "reconciliation_key", F.lit(True).alias("mended")).distinct(), ["run", "reconciliation_key"], "left")
        mended = F.coalesce("mended", F.lit(False))
    status = F.when(F.col("status") == "EXCEPTION", OPEN).when(mended, CORRECTED).otherwise(LATE)
    return rows.select(*within, "run", "reconciliation_key", "initial_exception_proof_id", "case_revision", status.alias("case_status"), F.col("had").alias("reason_codes"))


COMPARED = ("a", "b", "c", "d")


def chain_faults(proofs: DataFrame, results: DataFrame | None, cases: DataFrame | None, runs: int, corrected: DataFrame | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """run, reconciliation_key, fault of all revisions, in one plan over tables that hold every run (1 to runs).

    PROOF_ID: not derived from its fields; BROKEN_CHAIN: doesn't continue the key's proof of the run
    before; VANISHED: the next run has no proof of the key; RESULT: the run's result row differs from the
    proof, or either is alone; CASE: the run's case differs from the one that all proofs up to it
    give, or either is alone.

    The tables are one union that is shuffled once by key; a key's rows then meet in windows and one aggregate.
    within: columns of all tables that the key determines; tables that are all dealt by these aren't shuffled at all.
    """
    texts = lambda *names: [F.col(n).cast("string").alias(c) if n else F.lit(None).cast("string").alias(c) for c, n in zip(COMPARED, names, strict=True)]
    shown = ("status", "reason_codes", "difference_minor", None)
    if corrected is not None:
        proofs = proofs.join(corrected.select("run", "reconciliation_key", F.lit(True).alias("mended")).distinct(), ["run", "reconciliation_key"], "left")
    own = {"revision": F.col("revision").cast("bigint"), "proof_id": F.col("proof_id"), "prior_proof_id": F.col("prior_proof_id"), "forged": F.col("proof_id") != proof_id("grain", "revision", "manifest_sha256", "policy_sha256"), "mended": F.lit(False) if corrected is None else F.coalesce("mended", F.lit(False))}
    kinds = {"revision": "bigint", "proof_id": "string", "prior_proof_id": "string", "forged": "boolean", "mended": "boolean"}
    rows = lambda df, kind, names, more: df.select(*within, "reconciliation_key", F.col("run").cast("int").alias("run"), F.lit(kind).alias("kind"), *texts(*names), *(more.get(c, F.lit(None).cast(k)).alias(c) for c, k in kinds.items()))
    every = rows(proofs, "P", shown, own)
    if results is not None:
        every = every.unionByName(rows(results, "R", shown, {}))
    if cases is not None:
        every = every.unionByName(rows(cases, "C", ("initial_exception_proof_id", "case_revision", "case_status", "reason_codes"), {}))
    if not within:
        every = every.repartition("reconciliation_key")

    key = ("reconciliation_key", *within)
    order = Window.partitionBy(*key, "kind").orderBy("run")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    broken = lambda c: F.when(F.col("a") == "EXCEPTION", F.col(c))
    linked = every.withColumns({"before": F.lag("proof_id").over(order), "number": F.coalesce(F.lag("revision").over(order), F.lit(0)) + 1, "next": F.lead("run").over(order), "initial": F.first(broken("proof_id"), ignorenulls=True).over(so_far), "had": F.last(broken("b"), ignorenulls=True).over(so_far)})
    linked = linked.withColumn("case_revision", F.count("initial").over(so_far))
    tests = {
        "PROOF_ID": F.col("forged"),
        "BROKEN_CHAIN": ~F.col("prior_proof_id").eqNullSafe(F.col("before")) | (F.col("revision") != F.col("number")),
        "VANISHED": (F.col("run") < runs) & (F.coalesce("next", F.lit(0)) != F.col("run") + 1),
    }
    status = F.when(F.col("a") == "EXCEPTION", OPEN).when(F.col("mended"), CORRECTED).otherwise(LATE)
    item = lambda name, run, side, values: F.struct(F.lit(name).alias("fault"), run.alias("run"), F.lit(side).alias("side"), F.struct(*(v.cast("string").alias(c) for c, v in zip(COMPARED, values, strict=True))).alias("v"))
    is_a, run, null = lambda kind: F.col("kind") == kind, F.col("run"), F.lit(None)
    items = [F.when(is_a("P") & test, item(name, run + (1 if name == "VANISHED" else 0), 2, [null] * 4)) for name, test in tests.items()]
    if results is not None:
        items += [F.when(is_a(kind), item("RESULT", run, side, [F.col(c) for c in COMPARED])) for kind, side in (("P", 0), ("R", 1))]
    if cases is not None:
        items += [F.when(is_a("P") & F.col("initial").isNotNull(), item("CASE", run, 0, [F.col("initial"), F.col("case_revision"), status, F.col("had")])), F.when(is_a("C"), item("CASE", run, 1, [F.col(c) for c in COMPARED]))]
    each = linked.select(*key, F.explode(F.array(*items)).alias("i")).where("i IS NOT NULL").select(*key, "i.*")
    # What stands on one side only, or isn't the same on both, is one fault; a proof's own faults are one each.
    met = each.groupBy(*key, "run", "fault").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count_if(F.col("side") == 0).alias("x"), F.count_if(F.col("side") == 1).alias("y"), F.count_if(F.col("side") == 2).alias("own"))
    n = F.when(F.col("own") > 0, F.col("own")).when((F.col("x") == 0) | (F.col("y") == 0) | ~F.col("low").eqNullSafe(F.col("high")), 1).otherwise(0).cast("int")
    return met.withColumn("n", n).where("n > 0").select("run", "reconciliation_key", F.explode(F.array_repeat("fault", F.col("n"))).alias("fault"))

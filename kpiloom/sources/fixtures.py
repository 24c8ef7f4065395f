"""Fixtures W, T, S, B, P and the long tables K / K' over the driver tables.

Roles: region = county, nation = district, supplier = school, order year =
school year, market segment = demographic.  W, T and B are written once to the
scratch folder and read there, S and P are lazy;
the same shapes exist as SQL text in ``kpiloom.plans.oracle_sql`` for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.session import materialized
from kpiloom.sources.tables import Tables


def _s(c: Column) -> Column:
    return c.cast("string")


def line_items(t: Tables) -> DataFrame:
    """One narrow row per line item with its year, school number, segment and
    customer.  Orders meet their customers first, so line items are shuffled once
    for the join, without the names of their school."""
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_quantity")
    od = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("yr"))
    cu = t.customer.select("c_custkey", "c_mktsegment")
    of = od.join(cu, od.o_custkey == cu.c_custkey)
    j = li.filter("l_suppkey IS NOT NULL").join(of, li.l_orderkey == of.o_orderkey)
    return j.select("yr", F.col("l_suppkey").alias("supp"), F.col("c_mktsegment").alias("seg"),
                    F.col("o_custkey").alias("cust"), F.col("l_returnflag").alias("rf"),
                    F.col("l_linenumber").alias("ln"), F.col("l_quantity").alias("q"))


def by_school_year(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of line items, those of a school and year together: all groups
    below are within one, so the narrow rows are shuffled, not their aggregates."""
    return rows.select("yr", "supp", *columns).repartition("yr", "supp")


def schools(t: Tables) -> DataFrame:
    """(supp, county, district, copies): the places of a school number; ``copies``
    says how often each is listed, as a join would repeat the rows of the school."""
    su = t.supplier.select("s_suppkey", "s_nationkey")
    # nation / region are tiny: the planner's size-based broadcast (file statistics
    # against spark.sql.autoBroadcastJoinThreshold) picks them up without a hint
    na = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    re = t.region.select("r_regionkey", "r_name")
    placed = su.join(na, su.s_nationkey == na.n_nationkey).join(re, na.n_regionkey == re.r_regionkey)
    return (placed.groupBy(F.col("s_suppkey").alias("supp"), F.col("r_name").alias("county"), F.col("n_name").alias("district"))
                  .agg(F.count(F.lit(1)).alias("copies")))


def at_schools(grouped: DataFrame, t: Tables, counts: list[str]) -> DataFrame:
    """Groups of a school number at each of its places, ``counts`` times its copies."""
    placed = grouped.join(schools(t), "supp")
    return placed.withColumns({c: F.col(c) * F.col("copies") for c in counts}).drop("copies")


def _school_cols() -> list[Column]:
    return [
        F.concat(_s(F.col("yr") - 1), _s(F.col("yr"))).alias("school_year"),
        F.col("county").alias("county_name"), F.col("district").alias("district_name"),
        F.lpad(_s(F.col("supp")), 6, "0").alias("school_code"),
        F.concat(F.lit("School "), _s(F.col("supp"))).alias("school_name"),
    ]


N_PARTS = 15
BY_YEAR = ["school_year"]
WIDE_COLUMNS = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic", "suppressed",
                "total_count", "a_count", "n_count", "r_count", "qty_text", "r_rate"]


def wide(t: Tables) -> DataFrame:
    """W: counts per (school year, school, segment) plus a school total row."""
    return wide_parts(t, WIDE_COLUMNS)


def wide_parts(t: Tables, columns: list[str] | None = None, rows: DataFrame | None = None, by_year: bool = False) -> DataFrame:
    """W with a second rate and the counts of ``N_PARTS`` bands of quantity, or
    ``columns`` of it; the others are not computed.  ``rows``: line items that
    the caller has stored.  Written once, so the filters and branches of a query
    work on the groups and not again on the line items; ``by_year``: those of a
    year together."""
    found = _wide(t, line_items(t) if rows is None else rows)
    return materialized(found.select(*columns) if columns else found, "wide", BY_YEAR if by_year else None)


def _wide(t: Tables, rows: DataFrame) -> DataFrame:
    ids = ["yr", "county", "district", "supp"]
    rf = F.col("rf")
    counts = {"n": F.count(F.lit(1)), "a": F.count_if(rf == "A"), "nn": F.count_if(rf == "N"), "r": F.count_if(rf == "R"), "qs": F.sum("q"),
              **{f"b{i}": F.count_if(F.floor((F.col("q") - 1) * N_PARTS / 50) == i) for i in range(N_PARTS)}}
    per_seg = by_school_year(rows, "seg", "rf", "q").groupBy("yr", "supp", "seg").agg(*[v.alias(k) for k, v in counts.items()])
    # both grouping levels come out of a single aggregate over the groups of segments
    g = at_schools(per_seg, t, list(counts)).groupingSets([[*ids, "seg"], ids], *ids, "seg").agg(*[F.sum(c).alias(c) for c in counts])
    n, yr, seg = F.col("n"), F.col("yr"), F.col("seg")
    small = n < 10

    def masked(c: str, name: str) -> Column:
        return F.when(small, F.lit("*")).otherwise(_s(F.col(c))).alias(name)

    demographic = (F.when(seg.isNull(), F.lit("All Students"))
                    .when((seg == "AUTOMOBILE") & (yr < 1998), F.lit("automobile"))
                    .when((seg == "BUILDING") & (yr == 2001), F.lit("Bldg"))
                    .when((seg == "HOUSEHOLD") & (yr >= 2000), F.lit("HOUSEHOL"))
                    .when((seg == "MACHINERY") & (yr == 1996), F.lit("Mystery Group"))
                    .otherwise(seg))
    qty = (F.col("qs") * 100).cast("bigint")
    return g.select(
        *_school_cols(),
        demographic.alias("demographic"),
        F.when(small, F.lit("Yes")).otherwise(F.lit("No")).alias("suppressed"),
        masked("n", "total_count"), masked("a", "a_count"), masked("nn", "n_count"), masked("r", "r_count"),
        F.when(small, F.lit("*")).otherwise(F.format_number(qty, 0)).alias("qty_text"),
        F.when(small, F.lit("---")).otherwise(
            F.concat(_s(F.round(F.lit(1e2) * F.col("r") / n, 1)), F.lit("%"))).alias("r_rate"),
        F.when(small, F.lit("---")).otherwise(
            F.concat(_s(F.round(F.lit(1e2) * F.col("a") / n, 1)), F.lit("%"))).alias("a_rate"),
        *[masked(f"b{i}", f"part_{i}") for i in range(N_PARTS)],
    )


def tiers(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """T: per-segment event counts, All Students = distinct customers,
    Total Events = all events of the school.  Written once, like W.

    A customer of a school is one row of a pre-aggregate (a customer has one
    segment), which one aggregate takes to segments and to schools; a school's
    counts then give its rows of both kinds; no count-distinct expansion."""
    return materialized(_tiers(t, line_items(t) if rows is None else rows), "tiers")


def _tiers(t: Tables, rows: DataFrame) -> DataFrame:
    events, affected = ["t", "a", "r"], ["ct", "ca", "cr"]
    rf = F.col("rf")
    per_cust = by_school_year(rows, "seg", "cust", "rf").groupBy("yr", "supp", "seg", "cust").agg(
        F.count(F.lit(1)).alias("t"), F.count_if(rf == "A").alias("a"), F.count_if(rf == "R").alias("r"))
    levels = per_cust.groupingSets([["yr", "supp", "seg"], ["yr", "supp"]], "yr", "supp", "seg").agg(
        *[F.sum(c).alias(c) for c in events], F.count(F.lit(1)).alias("ct"), F.count_if(F.col("a") > 0).alias("ca"),
        F.count_if(F.col("r") > 0).alias("cr"), F.grouping("seg").alias("whole"))

    def row(label: Column, counts: list[str], times: int = 1) -> Column:
        return F.struct(label.alias("demographic"), *[(F.col(c) * times).alias(o) for c, o in zip(counts, events)])

    everyone = F.lit("All Students")
    # planted: every fiftieth school delivers its affected row twice, with other numbers
    again = F.when(F.col("supp") % 50 == 0, row(everyone, affected, 2))
    school = F.array_compact(F.array(row(everyone, affected), again, row(F.lit("Total Events"), events)))
    g = at_schools(levels, t, events).select(
        "yr", "supp", "county", "district", F.inline(F.when(F.col("whole") == 1, school).otherwise(F.array(row(F.col("seg"), events)))))
    supp = F.col("supp")
    return g.select(
        *_school_cols(), "demographic",
        _s(F.col("t")).alias("total_events"),
        F.when(F.col("a") < 2, F.lit("*")).otherwise(_s(F.col("a"))).alias("alpha_events"),
        _s(F.col("r")).alias("return_events"),
        F.when(supp % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("S"), _s(supp))).alias("state_school_id"))


def survey(t: Tables) -> DataFrame:
    """S: one survey answer per event."""
    uid, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    return t.events.select(
        F.lit("20232024").alias("school_year"),
        F.concat(F.lit("D"), _s(uid % 5)).alias("district_name"),
        F.lpad(_s(uid % 50), 6, "0").alias("school_code"),
        F.when(uid % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("C"), _s(uid % 3))).alias("co_op"),
        (F.when(et == "click", "C").when(et == "view", " climate ")
          .when(et == "error", "S").when(et == "signup", "Safety")).alias("question_type"),
        (F.when(eid % 17 == 0, F.lit("*")).when(eid % 19 == 0, F.lit(""))
          .otherwise(_s(F.col("value")))).alias("question_index"))


def bands(t: Tables, rows: DataFrame | None = None, by_year: bool = False) -> DataFrame:
    """B: four assessment bands per (school, subject, grade spelling).  Written once, like W."""
    return materialized(_bands(t, line_items(t) if rows is None else rows), "bands", BY_YEAR if by_year else None)


def _bands(t: Tables, rows: DataFrame) -> DataFrame:
    q, rf, ln5 = F.col("q"), F.col("rf"), F.col("ln") % 5
    per_grade = by_school_year(rows, "rf", "ln", "q").groupBy("yr", "supp", "rf", ln5.alias("ln5")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(q <= 12).alias("b1"), F.count_if((q > 12) & (q <= 25)).alias("b2"),
        F.count_if((q > 25) & (q <= 38)).alias("b3"), F.count_if(q > 38).alias("b4"))
    g = at_schools(per_grade, t, ["n", "b1", "b2", "b3", "b4"])
    n = F.col("n")
    small = n < 5

    def band(c: str, name: str) -> Column:
        return F.when(small, F.lit("*")).otherwise(_s(F.round(F.lit(1e2) * F.col(c) / n))).alias(name)

    ln = F.col("ln5")
    return g.select(
        *_school_cols(), F.lit("All Students").alias("demographic"),
        F.when(rf == "A", "MA").when(rf == "N", "Reading").otherwise("Science").alias("subject"),
        (F.when(ln == 0, "03").when(ln == 1, "Grade 7").when(ln == 2, "11")
          .when(ln == 3, "All Grades")).alias("grade"),
        F.when(small, "Y").otherwise("N").alias("suppressed"),
        band("b1", "novice"), band("b2", "apprentice"), band("b3", "proficient"), band("b4", "distinguished"))


def policies(t: Tables) -> DataFrame:
    """P: eight Yes/No policy answers per part (school)."""
    pk, size = F.col("p_partkey"), F.col("p_size")

    def answer(i: int) -> Column:
        k = (pk + i * size) % 5
        return (F.when(k == 0, "Yes").when(k == 1, " yes ").when(k == 2, "YES")
                 .when(k == 3, "No")).alias(f"policy_{i}")

    return t.part.select(F.lpad(_s(pk), 6, "0").alias("school_code"),
                         F.col("p_brand").alias("district_name"),
                         *[answer(i) for i in range(1, 9)])

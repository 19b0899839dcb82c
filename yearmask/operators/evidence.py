"""Host-year evidence: masks, baselines, planning, classification, canonical proofs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearmask.functions.hosts import ALL_YEARS, bit, classify_source, host_of, normalize_host, novel_mask, year_of, years_in


def mask_by_host(host_years: DataFrame, host: str = "host", year: str = "year") -> DataFrame:
    """One mask a host. Partial aggregation makes the shuffle one row a host and task."""
    return host_years.groupBy(F.col(host).alias("host")).agg(F.bit_or(bit(F.col(year))).alias("year_mask"))


def capture_summary(captures: DataFrame, order: str, locator: str) -> DataFrame:
    """Mask, captures, and first and last locator of each host by ``order``."""
    return captures.groupBy("host").agg(F.bit_or(bit(F.col("year"))).alias("year_mask"), F.count("*").alias("captures"), F.min_by(locator, order).alias("first_locator"), F.max_by(locator, order).alias("last_locator"))


def witnesses(captures: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """For each host the first real capture of each year (six at most), by year."""
    first = captures.groupBy("host", "year").agg(F.min_by(F.struct("year", *columns), order).alias("w"))
    return first.groupBy("host").agg(F.array_sort(F.collect_list("w")).alias("witnesses"))


def resolve(hosts: DataFrame, baseline: DataFrame, candidates: DataFrame) -> DataFrame:
    """Adds the baseline mask (0 if none) and whether a host is a candidate. Sides are as they come: the join is an
    equi-join on host that Spark broadcasts only where it measures a side as small."""
    known = candidates.select("host").distinct().withColumn("is_candidate", F.lit(True))
    out = hosts.join(baseline.select("host", F.col("year_mask").alias("baseline_mask")), "host", "left").join(known, "host", "left")
    return out.withColumns({"baseline_mask": F.coalesce("baseline_mask", F.lit(0)), "is_candidate": F.coalesce("is_candidate", F.lit(False))})


def subtract(masks: DataFrame, baseline: DataFrame, target: int = ALL_YEARS) -> DataFrame:
    """Masks without what the baseline has, other columns kept; hosts with nothing left go."""
    joined = masks.join(baseline.select("host", F.col("year_mask").alias("known")), "host", "left")
    return joined.withColumn("novel_mask", novel_mask(F.col("year_mask"), F.coalesce("known", F.lit(0)), F.lit(target))).where("novel_mask <> 0").drop("known")


def novel_host_years(accepted: DataFrame, baseline: DataFrame) -> DataFrame:
    """Distinct accepted (host, year) that the baseline lacks."""
    return accepted.select("host", "year").distinct().join(baseline.select("host", "year"), ["host", "year"], "left_anti")


def coverage_mask(tasks: DataFrame) -> DataFrame:
    """Years covered by tasks that ended with proof or by exhaustion; nothing else covers a year."""
    done = tasks.where(F.col("state").isin("PASS", "EMPTY_EXHAUSTIVE") & (F.col("year_from") <= F.col("year_to")))
    bits = F.aggregate(F.sequence("year_from", "year_to"), F.lit(0), lambda a, y: a.bitwiseOR(bit(y)))
    return done.groupBy("host").agg(F.bit_or(bits).alias("covered_mask"))


def plan(observations: DataFrame) -> DataFrame:
    """direct_mask and query_mask of observations with official, local and covered masks. Hints are never proof:
    without authority, or from the excluded corpus, all open years are asked for and none is direct."""
    closed = F.col("official_mask").bitwiseOR(F.col("local_mask"))
    free = F.col("allow_direct") & (F.col("scope") != "COMMON_CRAWL_CORPUS_EXCLUDED")
    direct = F.when(free, F.col("direct_year_mask").bitwiseAND(F.bitwise_not(closed))).otherwise(0)
    hint = F.col("year_hint_mask").bitwiseOR(bit(F.col("source_year")))
    asked = F.when(~free | ((hint == 0) & (direct == 0)), F.lit(ALL_YEARS)).otherwise(hint)
    query = asked.bitwiseAND(F.bitwise_not(closed)).bitwiseAND(F.bitwise_not(direct)).bitwiseAND(F.bitwise_not(F.col("covered_mask")))
    return observations.withColumn("direct_mask", direct).withColumn("query_mask", query)


def year_ranges(masks: DataFrame, mask: str, keys: list[str]) -> DataFrame:
    """Runs of consecutive years of a mask (year_from, year_to). The years are in the row: no shuffle is needed."""
    years = years_in(F.col(mask))
    starts = F.filter(years, lambda y: ~F.array_contains(years, y - 1))
    ends = F.filter(years, lambda y: ~F.array_contains(years, y + 1))
    return masks.select(*keys, F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("r")).select(*keys, F.col("r.a").alias("year_from"), F.col("r.b").alias("year_to"))


#: fixed values: what a capture's proof is called
CAPTURE_TYPES = ("exact_host_cdx_capture", "archive_capture", "platform_scope_cdx_capture")
CAPTURE_SEMANTICS = ("capture_timestamp_year", "archive_capture_timestamp")


def lane(bound: Column) -> Column:
    """B2: how a proof was acquired; ``bound``: whether a direct provider's contract is bound."""
    text = F.lower(F.concat_ws(" ", "provider", "evidence_type", "temporal_semantics", "extraction_method"))
    return (
        F.when(F.col("provider").startswith("direct:"), F.when(bound, "DIRECT_ANNUAL").otherwise("UNKNOWN"))
        .when((F.col("provider") == "rdap") | (F.col("evidence_type") == "rdap_registration_event") | (F.col("temporal_semantics") == "registration_event_year"), "REGISTRATION_YEAR")
        .when(text.contains("dns"), "DNS_REFERENCE")
        .when(F.col("evidence_type").isin(*CAPTURE_TYPES) & F.col("temporal_semantics").isin(*CAPTURE_SEMANTICS), "VERIFIED_CANDIDATE")
        .otherwise("UNKNOWN")
    )


def bucket(c: Column) -> Column:
    """The bucket that a lane contributes to."""
    return F.when(c == "DIRECT_ANNUAL", "direct_annual").when(c == "VERIFIED_CANDIDATE", "verified_candidate").otherwise("other_restricted")


def bound_contract(capsules: DataFrame, contracts: DataFrame) -> DataFrame:
    """Adds bound: the contract and version named in extraction_method are reviewed for that provider."""
    named = capsules.withColumns({"c_id": F.regexp_extract("extraction_method", r"contract=([^@;\s]+)@", 1), "c_version": F.regexp_extract("extraction_method", r"contract=[^@;\s]+@([^;\s]+)", 1)})
    known = contracts.select(F.col("contract_id").alias("c_id"), F.col("version").alias("c_version"), F.lit(True).alias("bound"))
    return named.join(known, ["c_id", "c_version"], "left").withColumn("bound", F.coalesce("bound", F.lit(False)))


def semantic_errors(capsules: DataFrame) -> DataFrame:
    """B1: the list of what is wrong with each capsule, and whether it is accepted (nothing is)."""
    checks = [
        (F.col("hostname").isNull() | ~normalize_host(F.col("hostname")).eqNullSafe(F.col("hostname")), "hostname_invalid"),
        (~F.coalesce(F.col("year").between(1996, 2001), F.lit(False)), "year_out_of_window"),
        (~year_of(F.col("evidence_timestamp")).eqNullSafe(F.col("year")), "timestamp_year_mismatch"),
        (~host_of(F.col("original_url")).eqNullSafe(F.col("hostname")), "url_host_mismatch"),
        (F.coalesce(F.col("payload_hash"), F.lit("")) == "", "payload_hash_missing"),
        (F.col("provider").startswith("direct:") & ~F.col("bound"), "contract_missing"),
    ]
    errors = F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in checks]))
    return capsules.withColumn("errors", errors).withColumn("accepted", F.size("errors") == 0)


def resolve_contract(sources: DataFrame, allowed: DataFrame, families: DataFrame) -> DataFrame:
    """The contract of a source: by its exact locator, else by its parser family, else discovery only."""
    a = allowed.select("locator", F.col("contract_id").alias("by_locator"))
    f = families.select("family", F.col("contract_id").alias("by_family"))
    return sources.join(a, "locator", "left").join(f, "family", "left").withColumn("contract_id", F.coalesce("by_locator", "by_family", F.lit("discovery_only"))).drop("by_locator", "by_family")


def reconcile(candidates: DataFrame, baseline: DataFrame, order: str) -> DataFrame:
    """The first record of each host and bucket: active (not in the baseline), reference, excluded, unparsed.
    Restricted sources keep their scope whatever the record says."""
    implied = classify_source(F.col("source_id"))
    scope = F.when(implied.isin("COMMON_CRAWL_CORPUS_EXCLUDED", "ISC_REFERENCE"), implied).otherwise(F.col("scope"))
    kind = F.when(F.col("h").isNull(), "unparsed").when(F.col("s") == "ISC_REFERENCE", "reference").when(~F.col("s").isin("OFFICIAL_POOL", "LOCAL_DISCOVERY"), "excluded").otherwise("active")
    rows = candidates.withColumns({"h": normalize_host(F.col("hostname")), "s": scope}).withColumn("bucket", kind)
    known = baseline.select(F.col("host").alias("h")).distinct()
    kept = rows.where("bucket = 'active'").join(known, "h", "left_anti").unionByName(rows.where("bucket <> 'active'"))
    return kept.groupBy("bucket", F.coalesce("h", "hostname").alias("host")).agg(F.min_by(F.struct("source_id", F.col("s").alias("scope"), F.col(order).alias("first")), order).alias("r")).select("bucket", "host", "r.*")


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key by a full chain of ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def insert_new(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that an idempotent insert would add: one a key, none that exists."""
    return new.join(existing.select(*keys), keys, "left_anti").dropDuplicates(keys)


def task_outcome(results: DataFrame) -> DataFrame:
    """The outcome of a task over its providers: a proof wins; emptiness needs all of them exhausted; what no provider
    can answer is invalid only when all have ended."""
    ended = F.bool_and(F.col("state").isin("EMPTY_EXHAUSTIVE", "INVALID"))
    outcome = (
        F.when(F.bool_or(F.col("state") == "PASS"), "PASS")
        .when(F.bool_and(F.col("state") == "EMPTY_EXHAUSTIVE"), "EMPTY_EXHAUSTIVE")
        .when(ended, "INVALID")
        .when(F.bool_or(F.col("state") == "TRANSIENT_ERROR"), "TRANSIENT_ERROR")
        .otherwise("INCOMPLETE")
    )
    return results.groupBy("task_id").agg(outcome.alias("outcome"))


def domain_matches(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """Hosts under each domain, itself included. Each host is exploded to its suffixes, so the join is by equality."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return hosts.select("host", F.explode(suffixes).alias("domain")).join(domains.select("domain").distinct(), "domain")

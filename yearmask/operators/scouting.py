"""Scouting of sources and regions: verdicts of samples, early decisions, eligible indexes, addresses to try, byte windows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: least hosts, novel hosts, novel share and EED of a warm sample; how many times that much settles a source
#: early; the unseen share below which a poor one is given up early
LEAST_HOSTS, LEAST_NOVEL, LEAST_SHARE, LEAST_EED, SURE_FACTOR, SEEN_ENOUGH = 100, 10, 0.01, 1.0, 4.0, 0.01
#: fixed values: endings of compressed files, which have no offsets to seek to
COMPRESSED = (".gz", ".bz2", ".xz", ".zst", ".zip")
FIRST, LAST = 1996, 2001


def yields(hosts: Column, novel: Column, eed: Column, times: float = 1.0) -> Column:
    """Whether a sample yields ``times`` the least that is asked of one."""
    share = novel / F.greatest(F.lit(1), hosts)
    return (novel >= LEAST_NOVEL * times) & (share >= min(1.0, LEAST_SHARE * times)) & (eed >= LEAST_EED * times)


def verdict(hosts: Column, novel: Column, eed: Column) -> Column:
    """Warm or hold."""
    return F.when((hosts >= LEAST_HOSTS) & yields(hosts, novel, eed), "WARM").otherwise("HOLD")


def early(hosts: Column, novel: Column, eed: Column, unseen: Column) -> Column:
    """What one stage of a growing sample settles: accept a warm one with several times the yield, reject one on hold
    that has hardly anything unseen and too few novel hosts or too little EED, else null."""
    warm, poor = verdict(hosts, novel, eed) == "WARM", (novel < LEAST_NOVEL) | (eed < LEAST_EED)
    accept = warm & yields(hosts, novel, eed, SURE_FACTOR)
    reject = ~warm & (hosts >= LEAST_HOSTS) & (unseen <= SEEN_ENOUGH) & poor
    return F.when(accept, "early_accept").when(reject, "early_reject")


def first_decisions(stages: DataFrame, source: str, stage: str, decision: str) -> DataFrame:
    """Of each source, the first stage that settles it and how; ``continue`` if none does."""
    settled = F.when(F.col(decision).isNotNull(), F.col(stage))
    return stages.groupBy(source).agg(F.coalesce(F.min_by(decision, settled), F.lit("continue")).alias("decision"), F.min(settled).alias("settled_at"))


def region_eligible(form: Column, locator: Column, direct: Column, ranges: Column) -> Column:
    """Whether regions of an index can be probed: direct evidence in CDX or CDXJ, not compressed, in a local file or
    behind HTTP with byte ranges. Nulls are no."""
    scheme = F.lower(F.regexp_extract(locator, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    path = F.lower(F.regexp_extract(locator, "^[^?#]*", 0))
    packed = path.rlike(f"(?:{'|'.join(c.replace('.', '[.]') for c in COMPRESSED)})$")
    reachable = scheme.isin("", "file") | (scheme.isin("http", "https") & F.coalesce(ranges, F.lit(False)))
    return F.coalesce(direct & form.isin("CDX", "CDXJ") & ~packed & reachable, F.lit(False))


def year_siblings(rows: DataFrame, url: str) -> DataFrame:
    """Rows whose file name has one target year, once for each other target year, with its address as ``sibling``."""
    found = F.array_distinct(F.regexp_extract_all(F.regexp_extract(url, r"([^/]*)\z", 1), F.lit(r"(?<!\d)(199[6-9]|200[01])(?!\d)"), 1))
    one = rows.withColumn("__years", found).where(F.size("__years") == 1)
    each = one.withColumn("__own", F.col("__years")[0]).withColumn("__other", F.explode(F.sequence(F.lit(FIRST), F.lit(LAST)).cast("array<string>"))).where("__own <> __other")
    pattern = F.concat(F.lit(r"(?<!\d)"), "__own", F.lit(r"(?!\d)(?=[^/]*$)"))
    return each.withColumn("sibling", F.regexp_replace(url, pattern, F.col("__other"))).drop("__years", "__own", "__other")


def expand_template(rows: DataFrame, template: str, lists: Mapping[str, Sequence[str | int]], most: int = 10_000) -> DataFrame:
    """``template`` with every ``{name}`` filled in, from columns of the rows and from lists, in all combinations of
    the lists; ``url`` holds the result. The lists alone multiply rows, by ``most`` at most."""
    lists = {name: list(dict.fromkeys(values)) for name, values in lists.items()}
    if math.prod(map(len, lists.values())) > most:
        raise ValueError(f"a template may make {most} addresses of a row at most")
    out, text = rows, F.lit(template)
    for name, values in lists.items():
        if "{" + name + "}" not in template or not values:
            raise ValueError(f"{name} needs a place in the template and values")
        out = out.withColumn(f"__{name}", F.explode(F.array(*[F.lit(str(v)) for v in values])))
        text = F.replace(text, F.lit("{" + name + "}"), F.col(f"__{name}"))
    for name in rows.columns:
        text = F.replace(text, F.lit("{" + name + "}"), F.col(name).cast("string")) if "{" + name + "}" in template else text
    return out.withColumn("url", text).drop(*[f"__{name}" for name in lists])


def payload_hash(*parts: Column | str) -> Column:
    """sha256 over parts joined by U+001F."""
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def provider_order(key: Column, weights: Mapping[str, float]) -> Column:
    """Providers in weighted rendezvous order for a key, by -ln(u) / weight, inside the row."""

    def scored(provider: str, weight: float) -> Column:
        head = F.conv(F.substring(F.sha2(F.concat(key, F.lit("|"), F.lit(provider)), 256), 1, 12), 16, 10).cast("double")
        return F.struct((-F.log((head + 0.5) / F.lit(float(1 << 48))) / weight).alias("s"), F.lit(provider).alias("p"))

    return F.transform(F.array_sort(F.array(*[scored(p, w) for p, w in weights.items()])), lambda x: x.p)


def bisect(start: Column, end: Column) -> Column:
    """Two halves [start, middle) and [middle, end) of a byte range, without overlap."""
    middle = start + F.floor((end - start) / 2)
    half = lambda i, a, b: F.struct(F.lit(i).alias("side"), a.alias("low"), b.alias("high"))
    return F.array(half(0, start, middle), half(1, middle, end))


def window_offsets(room: Column, windows: int) -> Column:
    """(win, offset) of evenly spaced windows, the first at 0 and the last at ``room``, the bytes before the last."""
    steps = max(1, windows - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda i: F.struct(i.cast("long").alias("win"), F.floor(i * room / steps).cast("long").alias("offset")))

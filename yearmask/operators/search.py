"""Search results: what they are (artifact, dataset, family), and how relevant their texts are to a search cell."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearmask.functions.hosts import family_label, strip, url_host

#: fixed values: words that name artifacts, kinds of results that are artifacts, and endings of artifacts' files
ARTIFACT_TERMS = ("dataset", "data set", "trace", "log", "dump", "list", "index", "catalog", "database", "archive")
ARTIFACT_KINDS = ("dataset", "collection", "software", "file", "datafile")
ARTIFACT_SUFFIXES = (
    ".txt", ".csv", ".tsv", ".json", ".jsonl", ".log", ".list", ".lst", ".dat", ".db", ".sqlite", ".sql", ".xml", ".rdf", ".zip", ".gz", ".bz2", ".xz",
    ".tar", ".tgz", ".warc", ".warc.gz", ".arc", ".arc.gz", ".cdx", ".cdx.gz", ".cdxj", ".cdxj.gz",
)
#: fixed values: least lengths of a title that stands for a family, and of one that identifies a dataset; longest label
SHORT_TITLE, STRONG_TITLE, LONGEST_LABEL = 6, 8, 240


def words(text: Column) -> Column:
    """The letters and digits of a text in lower case, runs of them between single spaces; empty for null."""
    return F.array_join(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]"), lambda w: w != ""), " ")


def keyed(prefix: str, *parts: Column) -> Column:
    """A prefix and the sha256 of parts joined by U+001F."""
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws("\x1f", *parts), 256))


def artifact_key(url: Column, checksum: Column, etag: Column, length: Column) -> Column:
    """A file's identity: its checksum, if that is a sha256, else its entity tag and length, else its address."""
    digest = F.lower(strip(checksum))
    return F.coalesce(
        F.when(digest.rlike("^[0-9a-f]{64}$"), F.concat(F.lit("artifact:sha256:"), digest)),
        F.when((etag != "") & length.isNotNull(), keyed("artifact:etag:", etag, length.cast("string"))),
        keyed("artifact:url:", url),
    )


def dataset_key(url: Column, doi: Column, title: Column, publisher: Column, creators: Column) -> Column:
    """A dataset's identity: its DOI, else title, publisher and first three creators if the title is long enough, else
    its address."""
    name = words(title)
    people = F.array_join(F.transform(F.slice(F.coalesce(creators, F.array().cast("array<string>")), 1, 3), words), "|")
    described = F.when(F.length(name) >= STRONG_TITLE, keyed("dataset:meta:", name, words(publisher), people))
    return F.coalesce(F.concat(F.lit("dataset:doi:"), doi), described, keyed("dataset:url:", url))


def family(url: Column, title: Column, publisher: Column) -> Column:
    """What all mirrors and versions of a dataset are called: the title without years and versions (the file's name or
    the host for want of one), with the publisher where the title doesn't name it, else with the host if it is short."""
    host, who = url_host(url), words(publisher)
    file = words(F.regexp_extract(url, "^[^/]*//[^/?#]*(?:/[^/?#]*)*/([^/?#]*)", 1))
    choices = (F.coalesce(family_label(title), F.lit("")), file)
    name = F.coalesce(*[F.when(F.length(c) >= SHORT_TITLE, c) for c in choices], host)
    other = F.when((who != "") & ~name.contains(who), who).when(F.length(name) < STRONG_TITLE, host)
    return F.substring(F.concat_ws(" | ", name, other), 1, LONGEST_LABEL)


def holds_any(text: Column, terms: Iterable[str]) -> Column:
    return F.coalesce(F.greatest(F.lit(False), *[text.contains(t) for t in terms], F.lit(False)), F.lit(False))


def relevance_of(mechanism: Column, year: Column, artifact: Column) -> Column:
    """Fixed weights of the three signs."""
    return 0.45 * mechanism.cast("int") + 0.35 * year.cast("int") + 0.2 * artifact.cast("int")


def relevance(text: Column, url: Column, kind: Column, published: Column, terms: Iterable[str], years: Iterable[int]) -> Column:
    """How well a result suits a search cell: its text holds a term of the cell's mechanism; it was published in one of
    the cell's years or names one; it is an artifact by its kind, its text or its address. Nulls are signs of nothing."""
    low, years = F.lower(F.coalesce(text, F.lit(""))), list(years)
    named = low.rlike(rf"\b(?:{'|'.join(map(str, years))})\b") if years else F.lit(False)
    year = named | F.coalesce(published.isin(years), F.lit(False))
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[^?#]*", 0))
    ends = path.rlike(f"(?:{'|'.join(s.replace('.', '[.]') for s in ARTIFACT_SUFFIXES)})$")
    artifact = F.coalesce(F.lower(kind).isin(*ARTIFACT_KINDS), F.lit(False)) | holds_any(low, ARTIFACT_TERMS) | ends
    return relevance_of(holds_any(low, terms), year, artifact)

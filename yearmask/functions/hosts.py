"""Column functions on hostnames, URLs, years and year masks. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1996, 2001
ALL_YEARS = (1 << (LAST_YEAR - FIRST_YEAR + 1)) - 1

#: fixed value: what a hostname has to match, of at most 253 characters
HOST_PATTERN = r"^(?=.{1,253}\z)(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}\z"


#: the characters that are white space in Unicode, and the four separators below U+0020
WHITE = " \t\n\r\x0b\f\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def strip(c: Column) -> Column:
    """Without white space at either end; cheaper than a pattern."""
    return F.btrim(c, F.lit(WHITE))


def normalize_host(c: Column) -> Column:
    """The hostname in lower case without white space around it, or null. The pattern is tried once a value."""
    return F.regexp_substr(F.lower(strip(c)), F.lit(HOST_PATTERN))


def url_host(c: Column) -> Column:
    """The host part of a URL as written in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_of(c: Column) -> Column:
    """The hostname of a URL, of ``//host``, of ``host/path`` or of a bare host, else null."""
    t = F.regexp_replace(strip(c), r"^[\"']+|[\"']+\z", "")
    full = F.when(t.contains("://") | t.startswith("//"), t).otherwise(F.concat(F.lit("http://"), t))
    return F.when(t.contains("/"), normalize_host(url_host(full))).otherwise(normalize_host(t))


def tld(c: Column) -> Column:
    """S3: the right-most label."""
    return F.element_at(F.split(c, r"\."), -1)


def depth(c: Column) -> Column:
    """Labels before the last two."""
    return F.size(F.split(c, r"\.")) - 2


def in_window(year: Column) -> Column:
    return F.when(year.between(FIRST_YEAR, LAST_YEAR), year)


def year_of(c: Column) -> Column:
    """The target year at the start of a compact (YYYY[MMDD[hhmmss]]) or ISO-like time, else null."""
    t = strip(c)
    good = t.rlike(r"^\d{4}(?:\d{4,10})?\z") | t.rlike(r"^\d{4}[-/T ]")
    return F.when(good, in_window(F.substring(t, 1, 4).try_cast("int")))


def bit(year: Column) -> Column:
    """The mask bit of a year; 0 outside of the window."""
    return F.coalesce(F.when(year.between(FIRST_YEAR, LAST_YEAR), F.pow(F.lit(2), year - FIRST_YEAR).cast("int")), F.lit(0))


def years_in(mask: Column) -> Column:
    """The years of a mask, ascending."""
    return F.filter(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR)), lambda y: mask.bitwiseAND(F.pow(F.lit(2), y - FIRST_YEAR).cast("int")) != 0)


def novel_mask(evidence: Column, baseline: Column, target: Column) -> Column:
    """The target years with evidence that the baseline lacks."""
    return evidence.bitwiseAND(F.bitwise_not(baseline)).bitwiseAND(target)


def registrable_parent(c: Column) -> Column:
    """The last two labels, three under a two-letter TLD; null if there are too few or an empty one."""
    labels = F.split(F.lower(F.regexp_replace(c, r"^\.+|\.+\z", "")), r"\.")
    need = F.when(F.length(F.element_at(labels, -1)) == 2, 3).otherwise(2)
    return F.when((F.size(labels) >= need) & ~F.exists(labels, lambda x: x == ""), F.array_join(F.slice(labels, F.size(labels) - need + 1, need), "."))


def parent_domain(c: Column) -> Column:
    """The host without its first label; null below three labels and for two labels under a two-letter TLD."""
    labels = F.split(c, r"\.")
    broad = (F.length(F.element_at(labels, -1)) == 2) & (F.size(labels) < 4)
    return F.when((F.size(labels) >= 3) & ~broad, F.array_join(F.slice(labels, 2, F.size(labels)), "."))


def clean_path(path: Column) -> Column:
    """A URL path with ``.`` and ``..`` resolved and slashes joined; a closing slash stays."""
    parts = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(path.endswith("/") & (F.size(kept) > 0), "/").otherwise(""))


def ascii_host(host: Column) -> Column:
    """A host beyond ASCII in its ASCII form (IDNA 2003); null if it has none. Other hosts never reach the converter."""
    return F.when(host.rlike(r"[^\x00-\x7F]"), F.lower(F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host))).otherwise(host)


def canonical_url(c: Column) -> Column:
    """Lower-case scheme and host, the host in ASCII, no default port, no fragment, a clean path, the query kept; null
    for other schemes, user information, no host or one without an ASCII form."""
    t = strip(c)
    scheme = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    place = F.regexp_extract(t, r"^[^/]*//([^/?#]*)", 1)
    port = F.regexp_extract(place, r":(\d+)\z", 1)
    default = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.regexp_extract(t, r"^[^/]*//[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(t, r"^[^?#]*(\?[^#]+)", 1)
    return F.when(scheme.isin("http", "https") & (url_host(t) != "") & ~place.contains("@"), F.concat(scheme, F.lit("://"), ascii_host(url_host(t)), F.when(default, "").otherwise(F.concat(F.lit(":"), port)), clean_path(path), query))


#: fixed values: query parameters that only track
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "msclkid")


def canonical_result_url(c: Column) -> Column:
    """The canonical URL with its query sorted and without ``utm_*`` and other tracking parameters."""
    u = canonical_url(c)
    parts = F.filter(F.split(F.regexp_extract(u, r"\?(.*)\z", 1), "&"), lambda p: (p != "") & ~F.lower(F.split(p, "=")[0]).startswith("utm_") & ~F.lower(F.split(p, "=")[0]).isin(*TRACKING))
    return F.concat(F.split(u, r"\?")[0], F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(parts), "&"))).otherwise(""))


def source_key(c: Column) -> Column:
    """sha256 of the canonical entry point."""
    return F.concat(F.lit("src:"), F.sha2(canonical_url(c), 256))


def origin(c: Column) -> Column:
    """Scheme and host of the canonical entry point."""
    return F.regexp_extract(canonical_url(c), r"^(https?://[^/?#]+)", 1)


#: fixed values: the forms of a DOI, of a year and of a version. Keys made of what is left have to be the same wherever they
#: are made, so these are given and not chosen here.
DOI_FORM = r"(?i)^(?:https?://(?:dx\.)?doi\.org/)?(10\.\d{4,9}/\S+)$"
YEAR_FORM = r"\b(?:199[0-9]|200[0-9])\b"
VERSION_FORM = r"\b(?:v(?:ersion)?\s*)?\d+(?:\.\d+){0,3}\b"


def doi(c: Column) -> Column:
    """The DOI that a text is, with or without its resolver's address, in lower case, else null. Full stops, commas and
    semicolons at its end aren't part of it."""
    found = F.lower(F.regexp_extract(F.rtrim(strip(c), F.lit(".,;")), DOI_FORM, 1))
    return F.when(found != "", found)


def first_doi(identifiers: Column) -> Column:
    """The first of several identifiers that is a DOI; null ones and others are passed over."""
    return F.get(F.filter(F.transform(identifiers, doi), lambda d: d.isNotNull()), F.lit(0))


def family_label(title: Column) -> Column:
    """The words of a title in lower case without years and versions, with single spaces between them."""
    words = F.concat_ws(" ", F.split(F.lower(title), "[^a-z0-9]+"))
    bare = F.regexp_replace(F.regexp_replace(words, YEAR_FORM, " "), VERSION_FORM, " ")
    return F.when(title.isNotNull(), F.trim(F.regexp_replace(bare, " +", " ")))


def classify_action(provider: Column, year_from: Column, year_to: Column, policy: Column) -> Column:
    """The kind of an evidence request."""
    return F.when(provider == "rdap", "RDAP").when(policy.startswith("cdx-domain-"), "DOMAIN").when(year_from == year_to, "EXACT").otherwise("RANGE")


def fraction_selected(host: Column, fraction: float) -> Column:
    """Whether a host falls into a fixed share of all hosts, by the first 60 bits of its sha256."""
    head = F.conv(F.substring(F.sha2(host, 256), 1, 15), 16, 10).cast("long")
    return head < F.lit(int(fraction * (1 << 60)))


#: fixed values: what names of sources hold that mean a scope
EXCLUDED_NAME, REFERENCE_NAMES, POOLS = "commoncrawl", ("iscreference", "networkwizards"), ("official_pool", "candidate_pool", "v3_candidate_pool")


def classify_source(source_id: Column) -> Column:
    """The scope that a source's name implies: a pool by its whole name, the reference by its beginning or a name in it,
    the excluded corpus by its name or the prefix ``cc``, local discovery otherwise. Only letters and digits count."""
    words = F.filter(F.split(F.lower(source_id), "[^a-z0-9]"), lambda w: w != "")
    letters = F.array_join(words, "")
    pool = F.array_join(words, "_").isin(*POOLS)
    reference = letters.startswith("isc") | letters.contains(REFERENCE_NAMES[0]) | letters.contains(REFERENCE_NAMES[1])
    excluded = letters.contains(EXCLUDED_NAME) | ((F.size(words) > 1) & (words[0] == "cc"))
    return (
        F.when(~pool & ~reference & ~excluded, "LOCAL_DISCOVERY")
        .when(excluded, "COMMON_CRAWL_CORPUS_EXCLUDED")
        .when(pool, "OFFICIAL_POOL")
        .when(reference, "ISC_REFERENCE")
        .otherwise("LOCAL_DISCOVERY")
    )


def parse_size(c: Column) -> Column:
    """Bytes of the last size in a text, such as ``12.5M`` (decimal units), rounded; null if there is none."""
    found = F.try_element_at(F.regexp_extract_all(F.upper(c), F.lit(r"(?<![\w.])(\d+(?:\.\d+)?\s*[KMGT]?)\s*B?(?!\w)"), 1), F.lit(-1))
    unit = F.regexp_extract(found, r"([KMGT]?)\z", 1)
    scale = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "G", 1e9).when(unit == "T", 1e12).otherwise(1.0)
    return F.bround(F.regexp_extract(found, r"^([\d.]+)", 1).try_cast("double") * scale).cast("long")


#: fixed values: words in links that name resources, and words that name collections of them
RESOURCE_TERMS = (
    "archive", "archives", "catalog", "catalogue", "collection", "collections", "dataset", "datasets", "directory", "directories",
    "dump", "export", "index", "indexes", "indices", "links", "resources", "sites", "urls", "websites",
)
META_TERMS = ("catalog", "catalogue", "collections", "datasets", "registry", "repositories", "resources")
#: fixed values: endings of bulk files
BULK_SUFFIXES = (
    ".7z", ".arc", ".arc.gz", ".bz2", ".cdx", ".cdx.gz", ".cdxj", ".cdxj.gz", ".csv", ".csv.gz", ".jsonl", ".jsonl.gz", ".list", ".list.gz", ".tar", ".tar.gz",
    ".tgz", ".tsv", ".tsv.gz", ".txt", ".txt.gz", ".urls", ".urls.gz", ".warc", ".warc.gz", ".xml.gz", ".xz", ".zip",
)


def link_hits(text: Column, terms: tuple[str, ...]) -> Column:
    """How many of the terms are tokens of a text."""
    return F.size(F.array_intersect(F.split(F.lower(text), "[^a-z0-9]+"), F.array(*map(F.lit, terms))))


def is_bulk(url: Column) -> Column:
    """Whether the path ends like a bulk file."""
    return F.lower(F.regexp_extract(url, r"^[^?#]*", 0)).rlike(f"(?:{'|'.join(x.replace('.', '[.]') for x in BULK_SUFFIXES)})$")

"""Messages of mailboxes as the mail standards have them: nested parts, encodings and character sets undone."""

from __future__ import annotations

import re
from collections.abc import Iterator
from email import policy
from email.message import EmailMessage
from email.parser import BytesParser
from email.utils import parsedate_to_datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearmask.functions.hosts import in_window
from yearmask.sources.lines import clean_urls, first

MESSAGE = "dates int, year int, texts array<string>"
YEAR = re.compile(r"\b(\d{4})\b")


def texts_of(part: EmailMessage) -> Iterator[str]:
    """The texts of a message in order. What is attached, or has a file name, counts with all that it holds as none."""
    if part.get_content_disposition() == "attachment" or part.get_filename() is not None:
        return
    if part.is_multipart():
        for inner in part.iter_parts():
            yield from texts_of(inner)
    elif part.get_content_maintype() == "text":
        raw = part.get_payload(decode=True) or b""
        try:
            yield raw.decode(part.get_content_charset() or "utf-8", errors="replace")
        except LookupError:  # a character set that nobody knows
            yield raw.decode("utf-8", errors="replace")


def year_of_date(text: str) -> int | None:
    """The year of a Date header; one that isn't written by the standard has the year that it names."""
    try:
        return parsedate_to_datetime(text).year
    except (TypeError, ValueError, OverflowError):
        named = YEAR.search(text)
        return int(named[1]) if named else None


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages, as bytes, to how many Date headers each has, the year of the first, and its texts."""
    parser = BytesParser(policy=policy.default)
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            rows = []
            for raw in batch.column(0).slice(at, 200):
                message = parser.parsebytes(raw.as_py() or b"")
                dates = [str(v).strip() for k, v in message.raw_items() if k.lower() == "date"]
                rows.append((len(dates), year_of_date(dates[0]) if dates else None, list(texts_of(message))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.list_(pa.string())))], names=["dates", "year", "texts"])


def mail_messages(messages: DataFrame, most: int | None = None) -> DataFrame:
    """(year, url) of mailbox messages (value: one message without its envelope's ``From ``): exactly one Date header,
    with a year in the window. URLs come from all texts of a message, each once, the first ``most`` if a bound is given;
    attachments aren't read. Messages without a URL, and null ones, have no row."""
    read = messages.select(F.col("value").cast("binary")).mapInArrow(walk, MESSAGE).withColumn("year", in_window(F.col("year"))).where("dates = 1 and year is not null")
    return read.select("year", F.explode(first(clean_urls(F.array_join("texts", "\n")), most)).alias("url"))

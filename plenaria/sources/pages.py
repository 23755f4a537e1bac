"""The change feed as a data source: pages by address, with the onward token of each category as the offset.

A page of the feed names the token of the next one, so the chain of pages is followed on the driver, which reads no more
of a page than it takes to see that link. The pages themselves are fetched by the tasks, some pages each.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from glob import glob
from typing import Any
from urllib.error import HTTPError, URLError
from urllib.parse import urlparse
from urllib.request import url2pathname, urlopen

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINK = re.compile(rb"<(?:\w+:)?link\b[^>]*>")
ONWARD, TOKEN = re.compile(rb"""\brel\s*=\s*["'](?:next|resume)["']"""), re.compile(rb"skiptoken=(\d+)")
FIRST_ENTRY = re.compile(rb"<(?:\w+:)?entry[\s>]")
#: Bytes that are read of a page at a time while its link is looked for, and seconds to wait for a page.
CHUNK, TIMEOUT = 16_384, 60
#: Pages that a task fetches, one after the other.
PAGES_A_TASK = 32
#: Token of the first page of a category, which is asked for without one.
NO_TOKEN = -1


@dataclass
class Page:
    """One page to fetch: category, the token it is asked for with, and its address."""

    category: str
    token: int
    url: str


@dataclass
class Pages(InputPartition):
    """Pages that one task fetches."""

    pages: list[Page]


def dealt(pages: list[Page]) -> list[Pages]:
    return [Pages(pages[i : i + PAGES_A_TASK]) for i in range(0, len(pages), PAGES_A_TASK)]


class Feed:
    """Addresses and chain of a feed's pages."""

    def __init__(self, options: dict[str, str]):
        self.url = options["url"]
        self.first = options.get("first_url", self.url)
        self.categories = [c.strip() for c in options.get("categories", "").split(",")]
        self.limit = int(options.get("pages", "100"))
        self.start = int(options.get("token", str(NO_TOKEN)))

    def address(self, category: str, token: int) -> str:
        return self.first.format(category=category, token="") if token == NO_TOKEN else self.url.format(category=category, token=token)

    def open(self, category: str, token: int) -> Any:
        """The open page, None where there is none yet."""
        url = self.address(category, token)
        if url.startswith("file:") and "*" in url:
            names = sorted(glob(url2pathname(urlparse(url).path)))
            return open(names[0], "rb") if names else None
        try:
            return urlopen(url, timeout=TIMEOUT)
        except HTTPError as error:
            if error.code != 404:
                raise
        except URLError as error:
            if not isinstance(error.reason, FileNotFoundError):
                raise
        return None

    def look(self, category: str, token: int) -> tuple[int | None, str] | None:
        """Onward token and, where that is none or no newer one, a digest of the page; None without a page or entries on it.

        Reading stops at the first link and entry that tell.
        """
        page = self.open(category, token)
        if page is None:
            return None
        with page:
            text, entries = b"", False
            while chunk := page.read(CHUNK):
                text += chunk
                entries = entries or bool(FIRST_ENTRY.search(text))
                onward = self.onward(text)
                if entries and onward is not None and onward > token:
                    return onward, ""
        return (self.onward(text), hashlib.sha256(text).hexdigest()[:16]) if entries else None

    @staticmethod
    def onward(text: bytes) -> int | None:
        """Token of the page's own link to the next page; links of entries do not count."""
        first = FIRST_ENTRY.search(text)
        head = text[: first.start()] if first else text
        # links may also stand behind the last entry
        tail = text[text.rfind(b"entry>") :] if first else b""
        for part in (head, tail):
            for link in LINK.findall(part):
                token = TOKEN.search(link)
                if ONWARD.search(link) and token:
                    return int(token[1])
        return None

    def walk(self, category: str, token: int, limit: int, links: dict[tuple[str, int], int] | None = None) -> tuple[list[int], dict[str, Any]]:
        """Tokens of the pages from one on, at most so many, and the offset behind them.

        It ends with a page that is missing or has no entries, and after one that leads to no newer token. Such a last
        page is told by its digest, so it is read again only when it has changed. ``links`` takes the onward tokens.
        """
        found: list[int] = []
        while len(found) < limit:
            seen = self.look(category, token)
            if seen is None:
                break
            onward, digest = seen
            found.append(token)
            if onward is None or onward <= token:
                return found, {"token": token, "last": digest}
            if links is not None:
                links[category, token] = onward
            token = onward
        return found, {"token": token, "last": ""}


class FeedReader(DataSourceReader):
    """All pages from the start token on, up to the page limit of a category."""

    def __init__(self, feed: Feed):
        self.feed = feed

    def partitions(self) -> list[Pages]:
        return dealt([Page(c, t, self.feed.address(c, t)) for c in self.feed.categories for t in self.feed.walk(c, self.feed.start, self.feed.limit)[0]])

    def read(self, part: Pages) -> Iterator[tuple]:
        return fetched(self.feed, part)


class FeedStreamReader(DataSourceStreamReader):
    """Pages behind the offset: by category the token to go on from, and the digest of a last page already read."""

    def __init__(self, feed: Feed):
        self.feed = feed
        self.head: dict[str, Any] | None = None
        # links seen since the last batch was planned, so that a page is looked at once
        self.links: dict[tuple[str, int], int] = {}

    def initialOffset(self) -> dict[str, Any]:
        return {c: {"token": self.feed.start, "last": ""} for c in self.feed.categories}

    def latestOffset(self) -> dict[str, Any]:
        if self.head is None:
            self.head = self.initialOffset()
        return {c: self.behind(c, at) for c, at in self.head.items()}

    def behind(self, category: str, at: dict[str, Any]) -> dict[str, Any]:
        found, after = self.feed.walk(category, at["token"], self.feed.limit, self.links)
        return after if found else at

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[Pages]:
        # a restarted query plans its last batch again before it asks for the latest offset
        self.head = end
        pages = []
        for category, after in end.items():
            before = start.get(category, {"token": self.feed.start, "last": ""})
            if before == after:
                continue
            token = before["token"]
            while token != after["token"]:
                pages.append(Page(category, token, self.feed.address(category, token)))
                onward = self.links.get((category, token))
                if onward is None:
                    seen = self.feed.look(category, token)
                    onward = None if seen is None else seen[0]
                if onward is None or onward <= token:
                    raise RuntimeError(f"the feed no longer leads from {before['token']} to {after['token']} in {category or 'all categories'}")
                token = onward
            if after["last"]:
                pages.append(Page(category, token, self.feed.address(category, token)))
        self.links.clear()
        return dealt(pages)

    def read(self, part: Pages) -> Iterator[tuple]:
        return fetched(self.feed, part)


def fetched(feed: Feed, part: Pages) -> Iterator[tuple]:
    for page in part.pages:
        opened = feed.open(page.category, page.token)
        if opened is None:
            raise RuntimeError(f"no page at {page.url}")
        with opened:
            yield page.url, opened.read().decode("utf-8-sig", "replace"), page.category, page.token


class FeedPages(DataSource):
    """Format ``feed_pages``: whole pages of a feed, in batch and as a stream.

    Options: ``url`` with ``{category}`` and ``{token}``, ``first_url`` for the page without a token (default: ``url``
    with an empty token), ``categories`` comma-joined (default: one chain for all), ``token`` to start from, and
    ``pages`` per category and batch (100). Addresses are whatever ``urllib`` opens: http, https or files; a file's
    address may hold ``*`` for the part of a name that its writer chose.
    """

    @classmethod
    def name(cls) -> str:
        return "feed_pages"

    def schema(self) -> str:
        return "path string, page string, category string, token bigint"

    def reader(self, schema: Any) -> DataSourceReader:
        return FeedReader(Feed(dict(self.options)))

    def streamReader(self, schema: Any) -> DataSourceStreamReader:
        return FeedStreamReader(Feed(dict(self.options)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(FeedPages)

"""Extension points: what a new source has to say, and where sources are looked up by name.

A source of organizations or providers gives DataFrames; a way to discover
addresses says how much it costs and whether it can be used. Sites are in
``rosterlake.plans.ingest.SiteAdapter``.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rosterlake.sources import bundles, files


class OrganizationAdapter(ABC):
    """A source of organizations: read as it is, then normalized to the columns of organizations."""

    name: str

    @abstractmethod
    def read(self, spark: SparkSession, path: str) -> DataFrame: ...

    @abstractmethod
    def normalize(self, rows: DataFrame) -> DataFrame: ...


class ProviderDatasetAdapter(ABC):
    """A source of providers as nested records (provider, locations, organizations)."""

    name: str
    #: Whether records without a profile address are incomplete.
    requires_profile_url: bool = False

    @abstractmethod
    def records(self, spark: SparkSession, path: str) -> DataFrame: ...


class HospitalFile(OrganizationAdapter):
    """The hospital file with a header."""

    name = "hospital-file"

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return files.read_csv(spark, path)

    def normalize(self, rows: DataFrame) -> DataFrame:
        return files.hospitals_from_csv(rows)


class ResourceSpool(ProviderDatasetAdapter):
    """A spool of directory resources as parquet."""

    name = "resource-spool"

    def records(self, spark: SparkSession, path: str) -> DataFrame:
        from rosterlake.plans.ingest import nested_records, resource_views

        return nested_records(resource_views(spark.read.parquet(path)))


class Registry:
    """Adapters by name; asking for one that isn't there names those that are."""

    def __init__(self, *known):
        self._known = {k.name: k for k in known}

    def add(self, one) -> None:
        self._known[one.name] = one

    def get(self, name: str):
        if name not in self._known:
            raise ValueError(f"unknown adapter {name!r}; known: {', '.join(sorted(self._known)) or 'none'}")
        return self._known[name]


ORGANIZATIONS = Registry(HospitalFile())
PROVIDERS = Registry(ResourceSpool())


@dataclass(frozen=True)
class Discovery:
    """A way to find addresses: its cost, and a function of landed tables that gives (url) or None if it can't be used."""

    name: str
    cost: int
    find: Callable[[dict[str, DataFrame]], DataFrame | None]


def by_sitemap(landed: dict[str, DataFrame]) -> DataFrame | None:
    return bundles.crawl_sitemaps(landed["sitemaps"], landed["starts"]) if {"sitemaps", "starts"} <= landed.keys() else None


def by_collection(landed: dict[str, DataFrame]) -> DataFrame | None:
    return bundles.jsonapi_rows(landed["collection"], "node--provider").selectExpr("path AS url") if "collection" in landed else None


DISCOVERIES = (Discovery("sitemap", 1, by_sitemap), Discovery("collection", 2, by_collection))


def discover(landed: dict[str, DataFrame], forced: str | None = None, ways: tuple[Discovery, ...] = DISCOVERIES) -> tuple[str, DataFrame]:
    """(name, urls) of the cheapest way that gives any address, or of the one that is forced. ValueError if there is none."""
    if forced and forced not in {w.name for w in ways}:
        raise ValueError(f"unknown source {forced!r}; known: {', '.join(w.name for w in ways)}")
    for w in sorted(ways, key=lambda w: w.cost):
        if forced in (None, w.name):
            urls = w.find(landed)
            if urls is not None and urls.take(1):
                return w.name, urls
    raise ValueError("no source gives any address")

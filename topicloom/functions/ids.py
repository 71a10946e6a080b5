"""Identifiers from URLs, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hosts whose path is a DOI.
DOI_HOSTS = ["doi.org", "dx.doi.org", "hdl.handle.net", "doi.wiley.com", "link.springer.com"]
DOI_QUERY_HOSTS = ["citeseerx.ist.psu.edu", "aeaweb.org"]


def _part(url: Column, pattern: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)


def domain(url: Column) -> Column:
    """The authority with port, without a leading "www."; empty if there is none."""
    return F.regexp_replace(_part(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"), r"^www\.", "")


def _path(url: Column) -> Column:
    path = _part(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)")
    return F.regexp_replace(path, "^/", "")


def _name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def identifier(url: Column) -> Column:
    """struct(id_type, id_value); both null where no rule applies."""
    host, path = domain(url), _path(url)
    name = _name(path)
    tail, parents = F.regexp_extract(path, r"([^/]*)$", 1), F.regexp_extract(path, r"^(.*?)/*[^/]*$", 1)
    doi = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?(?:[^#]*&)?doi=([^&#]+)", 1)
    some = lambda cond, kind, value: (cond, kind, value)
    rules = [
        some((host == "api.semanticscholar.org") & path.startswith("CorpusID:"), "s2", F.replace(path, F.lit("CorpusID:"), F.lit(""))),
        some(host == "pubmed.ncbi.nlm.nih.gov", "pmid", name),
        some((host == "ncbi.nlm.nih.gov") & path.startswith("pmc"), "pmc", name),
        some(host.isin(DOI_HOSTS), "doi", F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)),
        some((host == "worldcat.org") & path.contains("oclc"), "oclc", name),
        some((host == "worldcat.org") & path.contains("issn"), "issn", name),
        some(host == "ui.adsabs.harvard.edu", "ads", name),
        some((host == "jstor.org") & parents.contains("/"), "doi", F.concat(F.regexp_extract(parents, r"([^/]*)$", 1), F.lit("/"), tail)),
        some(host == "jstor.org", "doi", F.concat(F.lit("10.2307/"), tail)),
        some(host == "arxiv.org", "arxiv", F.regexp_replace(path, "^abs/", "")),
        some(host.isin(DOI_QUERY_HOSTS) & (doi != ""), "doi", F.coalesce(F.try_url_decode(doi), doi)),
    ]
    kind = value = None
    for cond, k, v in rules:
        kind = F.when(cond, k) if kind is None else kind.when(cond, k)
        value = F.when(cond, v) if value is None else value.when(cond, v)
    return F.struct(kind.alias("id_type"), value.alias("id_value"))


def pmc_key(url: Column) -> Column:
    """"PMC" and what follows the 42 characters of a catalogue's prefix."""
    return F.concat(F.lit("PMC"), F.substr(url, F.lit(43)))


def pmid_key(url: Column) -> Column:
    return F.substr(url, F.lit(33))

"""Addresses and headers of requests to catalogue services, as column expressions: a table of what to ask becomes a table of requests.

Keys never stand in an address, so that no cache key or log holds one; the contact address comes last, where the cache key cuts it off.
"""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.functions import text as X

AGENT = "quirelake/0.1"
# The services' addresses and the fields that are asked for.
BASES = {"semanticscholar": "https://api.semanticscholar.org/graph/v1", "crossref": "https://api.crossref.org", "openalex": "https://api.openalex.org"}
S2_FIELDS = "title,year,abstract,authors,externalIds,publicationTypes"
S2_SOURCE_FIELDS = "title,year,authors,externalIds,publicationTypes"
OPENALEX_FIELDS = "id,display_name,publication_year,authorships,doi,abstract_inverted_index,type"
OPENALEX_SOURCE_FIELDS = "id,display_name,publication_year,authorships,doi,type,referenced_works"
#: Services that want a contact address with a request.
POLITE = ("crossref", "openalex")
#: References of a work that one call gives, and works asked for in one call.
LIST_LIMIT, ID_BATCH = 1000, 100


def quoted(value: Column) -> Column:
    """``value`` as a part of an address: UTF-8, slashes kept."""
    out = F.url_encode(value)
    for made, kept in (("\\+", "%20"), ("%2F", "/"), ("%7E", "~"), ("\\*", "%2A")):
        out = F.regexp_replace(out, made, kept)
    return out


def _address(provider: str, mailto: str | None, *parts: Column | str) -> Column:
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    contact = [F.lit("&mailto="), quoted(F.lit(mailto))] if mailto and provider in POLITE else []
    return F.concat(F.lit(BASES[provider]), *columns, *contact)


def search_url(provider: str, title: Column, n: int = 1, mailto: str | None = None, source: bool = False) -> Column:
    """The search for ``n`` works by title; null where the title leaves nothing to search for. ``source`` asks for a work's own fields instead of a candidate's."""
    if provider == "semanticscholar":
        return _address(provider, mailto, "/paper/search?query=", quoted(title), f"&fields={S2_SOURCE_FIELDS if source else S2_FIELDS}&limit={n}")
    if provider == "crossref":
        return _address(provider, mailto, "/works?query.bibliographic=", quoted(title), f"&rows={n}")
    query = X.or_null(F.trim(X.catalogue_query(title)))
    return _address(provider, mailto, "/works?search=", quoted(query), f"&per-page={n}", f"&select={OPENALEX_SOURCE_FIELDS}" if source else "")


def doi_url(provider: str, doi: Column, mailto: str | None = None, source: bool = False) -> Column:
    """One work by its DOI. Crossref is asked by search only and has none."""
    if provider == "semanticscholar":
        return _address(provider, mailto, "/paper/DOI:", quoted(doi), f"?fields={S2_SOURCE_FIELDS if source else S2_FIELDS}")
    if provider == "openalex":
        return _address(provider, mailto, "/works/doi:", quoted(doi), f"?select={OPENALEX_SOURCE_FIELDS if source else OPENALEX_FIELDS}")
    return F.lit(None).cast("string")


def references_url(paper_id: Column) -> Column:
    """All references of a work, by the service's id of it."""
    return _address("semanticscholar", None, "/paper/", quoted(paper_id), f"/references?fields={S2_FIELDS}&limit={LIST_LIMIT}")


def works_url(ids: Column, mailto: str | None = None) -> Column:
    """The works of an array of at most :data:`ID_BATCH` ids."""
    return _address("openalex", mailto, "/works?filter=openalex_id:", F.array_join(ids, "|"), f"&per-page={ID_BATCH}&select={OPENALEX_FIELDS}")


def headers(provider: str, keys: dict[str, str] | None = None, mailto: str | None = None) -> dict[str, str]:
    """The headers of a request: who asks, and the service's key in the header it wants it in."""
    out = {"User-Agent": f"{AGENT} (mailto:{mailto})" if mailto and provider in POLITE else AGENT}
    key = (keys or {}).get(provider)
    if key and provider == "openalex":
        out["Authorization"] = f"Bearer {key}"
    elif key and provider == "semanticscholar":
        out["x-api-key"] = key
    return out


def redirected(sent: dict[str, str], url: str, target: str) -> dict[str, str]:
    """The headers that go on to ``target``: credentials stay on their host."""
    if urlsplit(url).hostname == urlsplit(target).hostname:
        return dict(sent)
    return {k: v for k, v in sent.items() if k.lower() not in ("authorization", "x-api-key")}

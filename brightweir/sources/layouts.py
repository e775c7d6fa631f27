"""Payload layouts of the five verticals.

Each layout maps its items to the raw columns of its vertical.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.text import bind, first_filled, strip
from brightweir.operators.validate import topical
from brightweir.sources.landing import SourceSpec


def _bad_type(**fits: tuple[Column, Column]) -> Column:
    """Name of the first field whose text is there and does not fit its type, else null."""
    return F.coalesce(*[F.when(text.isNotNull() & ~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, (text, ok) in fits.items()], F.lit(None))


def _list(text: Column, item: str) -> Column:
    """A JSON array kept as text; null if it is none."""
    return F.when(strip(text).startswith("["), F.from_json(text, f"array<{item}>"))


def _organisations(item: Column) -> dict[str, Column]:
    return {"login": strip(item["login"]), "url": strip(item["html_url"])}


def _models(item: Column) -> dict[str, Column]:
    return {"model_id": first_filled(item["id"], item["_id"])}


def _read_paper(item: Column) -> Column:
    def parts(paper: Column) -> Column:
        authors = _list(paper["authors"], "struct<name:string>")
        return F.struct(item["paper"].alias("paper"), item["title"].alias("title"), item["publishedAt"].alias("publishedAt"),
                        paper.alias("parsed"), authors.alias("authors"))

    return bind(F.from_json(item["paper"], _PAPER), parts)


def _papers(item: Column) -> dict[str, Column]:
    paper, authors = item["parsed"], item["authors"]
    named = F.filter(authors, lambda a: F.coalesce(a["name"], F.lit("")) != "")
    stars = paper["githubStars"].try_cast("int")
    # Fields that are not known make a record too, as long as there is one.
    nothing = F.coalesce(F.rlike(item["paper"], F.lit(r"^\s*(\{\s*\}|null)\s*$")), F.lit(True))
    return {
        "bad_type": _bad_type(
            paper=(item["paper"], F.rlike(item["paper"], F.lit(r"^\s*(\{|null)"))),
            authors=(paper["authors"], authors.isNotNull()),
            githubStars=(paper["githubStars"], stars.isNotNull()),
        ),
        "is_empty": nothing,
        "paper_id": paper["id"],
        "title": F.coalesce(first_filled(paper["title"], item["title"]), F.lit(fixed.UNTITLED_PAPER)),
        "authors": F.coalesce(F.transform(named, lambda a: strip(a["name"])), F.array().cast("array<string>")),
        "published_text": F.coalesce(first_filled(paper["publishedAt"], item["publishedAt"]), F.lit("")),
        "repo": paper["githubRepo"],
        "own_stars": stars,
    }


def _rss_news(item: Column) -> dict[str, Column]:
    return {
        "title": strip(item["title"]["_VALUE"]),
        "url": first_filled(item["link"]["_href"], strip(item["link"]["_VALUE"])),
        "published_text": strip(item["pubDate"]),
        "body": item["description"]["_VALUE"],
    }


def _atom_news(item: Column) -> dict[str, Column]:
    # An entry may carry several links; the first one with an address counts.
    links = F.transform(item["link"], lambda a: first_filled(a["_href"], strip(a["_VALUE"])))
    return {
        "title": strip(item["title"]["_VALUE"]),
        "url": F.get(F.filter(links, lambda a: a.isNotNull()), F.lit(0)),
        "published_text": first_filled(strip(item["published"]), strip(item["updated"])),
        "body": first_filled(item["summary"]["_VALUE"], item["content"]["_VALUE"]),
    }


def _job(
    company: Column,
    url: Column,
    published: Column,
    is_remote: Column | None = None,
    is_topical: Column | None = None,
    company_optional: bool = False,
) -> dict[str, Column]:
    return {
        "company": company,
        "url": url,
        "published_text": published,
        "is_remote": F.lit(True) if is_remote is None else is_remote,
        "is_topical": F.lit(True) if is_topical is None else is_topical,
        "company_optional": F.lit(company_optional),
    }


def _board_a(item: Column) -> dict[str, Column]:
    own = F.concat(F.lit(fixed.BOARD_A_PREFIX), F.coalesce(item["id"], F.lit("")))
    return _job(strip(item["company"]), F.coalesce(F.nullif(strip(item["url"]), F.lit("")), own), item["date"])


def _board_b(item: Column) -> dict[str, Column]:
    return _job(strip(item["companyName"]), strip(item["url"]), item["pubDate"])


def _board_c(item: Column) -> dict[str, Column]:
    return _job(strip(item["company_name"]), strip(item["url"]), item["publication_date"])


def _board_d(item: Column) -> dict[str, Column]:
    title = strip(item["title"])
    company = F.when(title.contains(":"), strip(F.substring_index(title, ":", 1))).otherwise(
        F.substring(title, 1, 30)
    )
    # A posting without an employer before the colon is kept; it resolves to "Unknown".
    return _job(company, strip(item["link"]), strip(item["pubDate"]), company_optional=True)


def _read_board_e(item: Column) -> Column:
    kept = [item[c].alias(c) for c in ("created_at", "company_name", "url", "tags", "title", "remote")]
    return F.struct(*kept, _list(item["tags"], "string").alias("tag_list"))


def _board_e(item: Column) -> dict[str, Column]:
    tags = item["tag_list"]
    remote = F.when(item["remote"].isin("true", "false"), item["remote"] == "true")
    fields = _job(
        strip(item["company_name"]),
        strip(item["url"]),
        item["created_at"],
        F.coalesce(remote, F.lit(True)),
        topical(tags, item["title"]),
    )
    return fields | {"bad_type": _bad_type(tags=(item["tags"], tags.isNotNull()), remote=(item["remote"], remote.isNotNull()))}


_PAPER = "id string,title string,authors string,publishedAt string,githubRepo string,githubStars string"
_MARKED = "struct<_VALUE:string,_type:string>"
_LINK = "struct<_VALUE:string,_href:string>"

LAYOUTS = {
    "organisations": SourceSpec(
        "startups", "json", "items array<struct<login:string,html_url:string>>", "items", _organisations
    ),
    "models": SourceSpec("products", "json", "array<struct<id:string,_id:string>>", "", _models),
    "papers": SourceSpec(
        "papers",
        "json",
        "array<struct<paper:string,title:string,publishedAt:string>>",
        "",
        _papers,
        prepare=_read_paper,
    ),
    "rss": SourceSpec(
        "news",
        "xml",
        f"channel struct<item:array<struct<title:{_MARKED},link:{_LINK},pubDate:string,description:{_MARKED}>>>",
        "channel.item",
        _rss_news,
    ),
    "atom": SourceSpec(
        "news",
        "xml",
        f"entry array<struct<title:{_MARKED},link:array<{_LINK}>,published:string,updated:string,"
        f"summary:{_MARKED},content:{_MARKED}>>",
        "entry",
        _atom_news,
    ),
    "board_a": SourceSpec(
        "jobs", "json", "array<struct<id:string,date:string,company:string,url:string>>", "", _board_a, skip=1
    ),
    "board_b": SourceSpec(
        "jobs", "json", "jobs array<struct<pubDate:string,companyName:string,url:string>>", "jobs", _board_b
    ),
    "board_c": SourceSpec(
        "jobs", "json", "jobs array<struct<publication_date:string,company_name:string,url:string>>", "jobs", _board_c
    ),
    "board_d": SourceSpec(
        "jobs",
        "xml",
        "channel struct<item:array<struct<title:string,link:string,pubDate:string>>>",
        "channel.item",
        _board_d,
    ),
    "board_e": SourceSpec(
        "jobs",
        "json",
        "data array<struct<created_at:string,company_name:string,url:string,tags:string,title:string,remote:string>>",
        "data",
        _board_e,
        prepare=_read_board_e,
    ),
}

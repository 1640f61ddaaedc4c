"""Facts from fetched pages (SRC3-SRC6, SRC9, SRC15, JSN1, HTM1-HTM5).

One mapInPandas pass reads each page with the standard library's parser and yields plain facts:
meta tags, JSON-LD texts, anchors, cards' texts, price containers, body text. Every decision is then
a Column expression over these facts. Layouts are data: a profile names the card, field and link
classes in order of preference.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.dates import listing_times
from kalends.functions.store import stored
from kalends.functions.text import blank, card_price, has, found, squeeze

SILENT = {"script", "style", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

#: Layouts. Each field lists class names (or tags) in order of preference.
LAYOUTS: dict[str, dict[str, list[str]]] = {
    "library_widget": {"card": ["s-lc-ea-e", "event-card"], "title": ["s-lc-ea-ttl", "h3"], "time": ["s-lc-ea-tm", "event-time"], "place": ["s-lc-ea-loc", "event-location"], "summary": ["s-lc-ea-des", "event-description"], "price": []},
    "county_parks": {"card": ["event-item", "views-row"], "title": ["event-title", "h3", "h2"], "time": ["event-date", "date"], "place": ["event-location"], "summary": ["event-description", "description"], "price": ["event-price"]},
    "date_spans": {"card": ["event-listing", "list-item"], "title": ["title", "h3"], "time": ["month", "day", "year"], "place": ["location"], "summary": ["summary", "description"], "price": []},
    "park_cards": {"card": ["card", "event"], "title": ["card-title", "title", "h3", "h2"], "time": ["card-date", "date", "time"], "place": ["card-location", "location"], "summary": ["card-text", "description", "p"], "price": ["price", "cost"]},
    "aggregator": {"card": ["tribe-events-calendar-list__event", "article"], "title": ["tribe-events-calendar-list__event-title", "h3"], "time": ["tribe-event-date-start", "time"], "place": ["tribe-events-calendar-list__event-venue", "venue"], "summary": ["tribe-events-calendar-list__event-description", "p"], "price": ["tribe-events-c-small-cta__price"]},
}
PRICE_CLASSES = ("price", "cost", "fee", "admission", "ticket")


class Facts(HTMLParser):
    """Collects one page's facts; a card's fields are the texts of elements whose class or tag the layout names."""

    def __init__(self, layout: dict[str, list[str]] | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.layout = layout or {"card": []}
        self.stack: list[tuple[str, set[str]]] = []
        self.meta: dict[str, str] = {}
        self.anchors: list[list[str]] = []
        self.json_ld: list[str] = []
        self.times: list[str] = []
        self.prices: list[str] = []
        self.body: list[str] = []
        self.cards: list[dict] = []
        self.open: list[tuple[int, list[str], object]] = []  # depth, text parts, what to do at the end
        self.page_title = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.body.append(" ")
        a = {k: v or "" for k, v in attrs}
        names = set(a.get("class", "").split()) | {tag}
        if tag == "meta":
            self.meta.setdefault(a.get("property") or a.get("name") or "", a.get("content", ""))
        if tag == "time" and a.get("datetime"):
            self.times.append(a["datetime"])
        if tag == "img" and self.cards and self._in_card():
            self.cards[-1].setdefault("image", a.get("src", ""))
        if tag in VOID:
            return
        depth = len(self.stack)
        self.stack.append((tag, names))
        if names & set(self.layout["card"]) and not self._in_card():
            self.cards.append({"_depth": depth})
        card = self.cards[-1] if self._in_card() else None
        if tag == "a":
            link = ["", a.get("href", "")]
            self.anchors.append(link)
            if card is not None:
                card.setdefault("href", a.get("href", ""))
            self.open.append((depth, [], lambda t, link=link: link.__setitem__(0, t)))
        if tag == "title":
            self.open.append((depth, [], lambda t: setattr(self, "page_title", t)))
        if tag == "script" and a.get("type", "").lower() == "application/ld+json":
            self.open.append((depth, [], self.json_ld.append))
        if any(p in n.lower() for n in names - {tag} for p in PRICE_CLASSES):
            self.open.append((depth, [], self.prices.append))
        if card is not None:
            for field, choices in self.layout.items():
                for rank, name in enumerate(choices):
                    if field != "card" and name in names:
                        self.open.append((depth, [], lambda t, card=card, field=field, rank=rank: card.setdefault(field, []).append((rank, t))))

    def _in_card(self) -> bool:
        return bool(self.cards) and len(self.stack) > self.cards[-1]["_depth"] and not self.cards[-1].get("_closed")

    def handle_endtag(self, tag: str) -> None:
        self.body.append(" ")
        if all(t != tag for t, _ in self.stack):
            return
        while self.stack:
            top, _ = self.stack.pop()
            depth = len(self.stack)
            done = [o for o in self.open if o[0] >= depth]
            self.open = [o for o in self.open if o[0] < depth]
            for _, parts, then in done:
                then(" ".join("".join(parts).split()))
            if self.cards and self.cards[-1]["_depth"] == depth:
                self.cards[-1]["_closed"] = True
            if top == tag:
                break

    def handle_data(self, data: str) -> None:
        for _, parts, _ in self.open:
            parts.append(data)
        if not any(t in SILENT or t == "title" for t, _ in self.stack):
            self.body.append(data)

    def finish(self) -> None:
        for tag, _ in reversed(list(self.stack)):
            self.handle_endtag(tag)


FACTS = {
    "meta": "map<string,string>", "page_title": "string", "anchors": "array<struct<text: string, href: string>>", "json_ld": "array<string>", "times": "array<string>", "price_texts": "array<string>", "body": "string",
    "cards": "array<struct<title: string, time: string, place: string, summary: string, price: string, href: string, image: string>>",
}
#: Characters of html whose facts are held at once; a longer page is alone.
HELD = 1 << 20


FIELDS = ["title", "time", "place", "summary", "price"]


def read_page(html: str | None, profile: dict[str, list[str]] | None) -> Facts:
    f = Facts(profile)
    f.feed(html or "")
    f.close()
    f.finish()
    return f


def card_fields(facts: Facts, profile: dict[str, list[str]] | None) -> list[dict]:
    """One dict per card, in the page's order: of each field the first text of the best class that the card has."""
    cards = []
    for c in facts.cards:
        best = {p: [t for r, t in c.get(p, []) if r == min(r for r, _ in c[p])] if c.get(p) else [] for p in FIELDS}
        if profile and profile["time"][:2] == ["month", "day"]:  # a date in several spans
            best["time"] = [" ".join(t for _, t in sorted(c.get("time", [])))]
        cards.append({p: (best[p] or [None])[0] for p in FIELDS} | {"href": c.get("href"), "image": c.get("image")})
    return cards


def portions(texts: list[str | None], most: int = HELD) -> Iterator[slice]:
    """Ranges of texts with so many characters at most, or of one text."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > start and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def page_facts(pages: DataFrame, layout: str | None = None, url: str = "url", html: str = "html", keep: list[str] = (), want: list[str] = tuple(FACTS)) -> DataFrame:
    """(url, wanted facts, kept string columns) for every row of pages; null html has empty facts. Malformed html never fails a row.

    Facts leave a task in portions, so a batch of many pages is never held as facts at once.
    """
    profile = LAYOUTS[layout] if layout else None
    made = {
        "meta": lambda f: f.meta, "page_title": lambda f: f.page_title or None, "anchors": lambda f: [{"text": t, "href": x} for t, x in f.anchors], "json_ld": lambda f: f.json_ld, "times": lambda f: f.times,
        "price_texts": lambda f: f.prices, "body": lambda f: " ".join("".join(f.body).split()), "cards": lambda f: card_fields(f, profile),
    }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in portions(pdf[html].tolist()):
                some = pdf.iloc[at]
                out = []
                for u, h in zip(some[url], some[html]):
                    f = read_page(h, profile)
                    out.append((u, *[made[n](f) for n in want]))
                yield pd.DataFrame(out, columns=["url", *want]).assign(**{k: some[k].to_numpy() for k in keep})

    return pages.select(url, html, *keep).mapInPandas(run, "url string" + "".join(f", {n} {FACTS[n]}" for n in want) + "".join(f", {k} string" for k in keep))


def absolute(href: Column, base: Column) -> Column:
    """A link made absolute against its page's URL."""
    root = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    return F.when(href.rlike("^https?://"), href).when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href)).when(F.startswith(href, F.lit("/")), F.concat(root, href)).when(F.coalesce(href, F.lit("")) != "", F.concat(root, F.lit("/"), href))


def cards(pages: DataFrame, layout: str, source_id: str, source_name: str) -> DataFrame:
    """SRC3-SRC6: raw records from listing pages, 0 to n per page; cards without a title or a link are left out."""
    return records(page_facts(pages, layout, want=["cards"]).select(F.col("url").alias("page_url"), F.inline("cards")), source_id, source_name)


def records(c: DataFrame, source_id: str, source_name: str) -> DataFrame:
    """Raw records from cards (page_url and a card's columns), however they were read."""
    times = listing_times(F.col("time"))
    title = squeeze(F.col("title"))
    got = c.filter(F.coalesce(title, F.lit("")) != "").select(
        F.lit(source_id).alias("source_id"), F.lit(source_name).alias("source_name"), absolute(F.col("href"), F.col("page_url")).alias("source_url"), title.alias("title"),
        F.coalesce(times["start_text"], F.col("time")).alias("start_text"), times["end_text"].alias("end_text"), times["all_day"].alias("all_day"), F.substring_index("place", " - ", 1).alias("location_text"),
        F.substring("summary", 1, 400).alias("summary_text"), F.coalesce(blank(F.col("price")), card_price(F.col("summary"))).alias("price_text"), absolute(F.col("image"), F.col("page_url")).alias("image_url"),
    )
    return got.filter("source_url is not null")


def seed_candidates(pages: DataFrame, source_name: str, layout: str = "aggregator") -> DataFrame:
    """SRC9: candidates (title, date, place, detail page) from an aggregator's listing pages."""
    c = page_facts(pages, layout, want=["cards"]).select(F.col("url").alias("page_url"), F.inline("cards")).filter(F.coalesce(F.trim("title"), F.lit("")) != "")
    return c.select(F.lit(source_name).alias("seed_source_name"), F.coalesce(absolute(F.col("href"), F.col("page_url")), F.col("page_url")).alias("seed_url"), squeeze(F.col("title")).alias("discovered_title"), F.col("time").alias("discovered_date_text"), F.col("place").alias("discovered_location_text"))


def body_text(html: Column) -> Column:
    """HTM5: flat text without scripts and styles, in Catalyst."""
    t = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ")
    return squeeze(F.regexp_replace(t, "(?s)<[^>]+>", " "))


def open_graph(meta: Column, page_title: Column) -> Column:
    """HTM1: facts from Open Graph and meta tags."""
    get = lambda *ks: F.coalesce(*[blank(F.try_element_at(meta, F.lit(k))) for k in ks])
    return _facts(title=F.coalesce(get("og:title"), blank(page_title)), description_snippet=F.substring(get("og:description", "description"), 1, 280), image_url=get("og:image"))


def _facts(**given: Column) -> Column:
    from kalends.operators.candidates import FACTS as NAMES

    return F.struct(*[given.get(n, F.lit(None)).cast("string").alias(n) for n in NAMES])


def html_facts(times: Column, price: Column) -> Column:
    """HTM2: facts from <time> elements and price text."""
    return _facts(start_text=F.try_element_at(times, F.lit(1)), end_text=F.try_element_at(times, F.lit(2)), cost_text=price)


def json_ld_events(df: DataFrame) -> DataFrame:
    """JSN1: df(url, json_ld array) -> (url, ld struct): the first filled value of each fact over the page's Events.

    Blocks count in order; a block may be an object, an array, or hold @graph. Texts that are no JSON are skipped.
    """
    block = df.select("url", F.posexplode("json_ld").alias("pos", "text")).withColumn("v", F.try_parse_json("text")).filter("v is not null")
    items = F.coalesce(F.try_variant_get("v", "$['@graph']", "array<variant>"), F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    node = block.select("url", "pos", F.posexplode(items).alias("sub", "e"))
    get = lambda p: F.nullif(F.trim(F.try_variant_get("e", p, "string")), F.lit(""))
    kind = F.coalesce(get("$['@type']"), get("$['@type'][0]"), F.lit(""))
    place = F.coalesce(get("$.location.name"), F.when(F.schema_of_variant(F.try_variant_get("e", "$.location", "variant")) == "STRING", get("$.location")))
    street = F.coalesce(F.nullif(F.concat_ws(", ", get("$.location.address.streetAddress"), get("$.location.address.addressLocality"), get("$.location.address.addressRegion")), F.lit("")), F.when(F.schema_of_variant(F.try_variant_get("e", "$.location.address", "variant")) == "STRING", get("$.location.address")))
    facts = {
        "title": get("$.name"), "start_text": get("$.startDate"), "end_text": get("$.endDate"), "location_name": place, "location_address": street, "cost_text": F.coalesce(get("$.offers.price"), get("$.offers[0].price")),
        "description_snippet": F.substring(get("$.description"), 1, 280), "registration_url": F.coalesce(get("$.offers.url"), get("$.offers[0].url")), "image_url": F.coalesce(get("$.image[0]"), get("$.image.url"), F.when(F.schema_of_variant(F.try_variant_get("e", "$.image", "variant")) == "STRING", get("$.image"))), "organizer": get("$.organizer.name"),
    }
    rows = node.filter(F.endswith(kind, F.lit("Event"))).select("url", F.struct("pos", "sub").alias("at"), *[v.alias(k) for k, v in facts.items()])
    first = rows.groupBy("url").agg(*[F.min_by(k, F.when(F.col(k).isNotNull(), F.col("at"))).alias(k) for k in facts])
    return first.select("url", F.struct(*facts).alias("ld"))


LABELLED = r"\b(?:cost|price|fee|admission|tickets?|registration)\s*[:\-]\s*([^.\n]{1,180})"
CALL_TO_ACTION = r"\b(?:register|buy tickets|book now|reserve|sign up)\b"
PRICED = r"(\$\s*\d[\d,.]*(?:\s*(?:[-/]|to)\s*\$?\d[\d,.]*)?(?:\s*(?:per\s+\w+|each|/\w+))?|\bfree(?:\s+(?:admission|event|of\s+charge))?\b|\bno\s+(?:charge|cost|fee)\b)"


def page_price(price_texts: Column, body: Column) -> Column:
    """HTM3: containers, then a labelled tail, then any price in the body, then one near a call to action."""
    box = F.try_element_at(F.filter(price_texts, lambda t: (F.trim(t) != "") & (F.char_length(t) <= 200)), F.lit(1))
    near = found(body, CALL_TO_ACTION + r".{0,600}?" + PRICED, 1)
    return F.nullif(F.trim(F.coalesce(blank(box), found(body, LABELLED, 1), found(body, PRICED, 1), near)), F.lit(""))


def detail_price(price_texts: Column, body: Column) -> Column:
    """HTM4: containers that name a price, then labelled, registration, free, and bare dollar texts."""
    box = F.try_element_at(F.filter(price_texts, lambda t: has(t, rules.DOLLAR) | has(t, r"\bfree\b")), F.lit(1))
    return F.nullif(F.trim(F.coalesce(blank(box), found(body, r"\b(?:cost|price|fee|admission)\s*[:\-]\s*(\$\s*\d[^.\n]{0,80}|free\b)", 1), found(body, r"\bregistration[^.$]{0,60}(\$\s*\d[\d,.]*)", 1), found(body, r"\b(free\s+(?:admission|event|of\s+charge|program)|no\s+(?:charge|cost|fee))\b", 1), found(body, r"(\$\s*\d[\d,.]*)", 1))), F.lit(""))


def with_detail_price(records: DataFrame, pages: DataFrame, cap: int | None = None) -> DataFrame:
    """SRC15: fills a missing price from the record's detail page; cap limits pages per source, off by default.

    Only records without a price are joined; pages(url, html) has one row per URL.
    """
    from pyspark.sql import Window

    priced, bare = records.filter(blank(F.col("price_text")).isNotNull()), records.filter(blank(F.col("price_text")).isNull())
    facts = page_facts(pages.groupBy("url").agg(F.min("html").alias("html")), want=["price_texts", "body"]).select(F.col("url").alias("source_url"), detail_price(F.col("price_texts"), F.col("body")).alias("_price"))
    met = bare.join(facts, "source_url", "left")
    if cap is not None:
        met = met.withColumn("_n", F.row_number().over(Window.partitionBy("source_id").orderBy("ingest_seq"))).withColumn("_price", F.when(F.col("_n") <= cap, F.col("_price"))).drop("_n")
    return priced.unionByName(met.withColumn("price_text", F.coalesce(blank(F.col("price_text")), F.col("_price"))).select(*records.columns))


def fetched(pages: DataFrame) -> DataFrame:
    """Pages as candidates need them: (url, final_url, anchors, facts, json_ld), facts merged by trust."""
    from kalends.operators.candidates import merge_facts

    final = F.col("final_url") if "final_url" in pages.columns else F.col("url")
    # one page per URL, always the same one; each is parsed once, and the facts are stored for both readers
    one = pages.groupBy("url").agg(F.min(F.struct(final.alias("final_url"), "html")).alias("_p")).select("url", "_p.*")
    f = stored(page_facts(one, keep=["final_url"]), "facts")
    ld = json_ld_events(f)
    both = f.join(ld, "url", "left")
    own = html_facts(F.col("times"), page_price(F.col("price_texts"), F.col("body")))
    return both.select("url", "final_url", "anchors", merge_facts(F.coalesce("ld", _facts()), open_graph(F.col("meta"), F.col("page_title")), own).alias("facts"), F.col("ld").isNotNull().alias("json_ld"))

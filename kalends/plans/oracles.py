"""DuckDB SQL for the registered queries, written apart from the Spark expressions over the same rule tables."""

from __future__ import annotations

import html
import html.entities

from kalends import rules
from kalends.functions import regions, urls
from kalends.plans import listing as fx


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(expr: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({expr}, {q('(?i)' + pattern)}), false)"


def words(expr: str, some: list[str]) -> str:
    return "coalesce(" + " or ".join(f"contains(lower({expr}), {q(w)})" for w in some) + ", false)"


def any_of(tags: str, some: list[str]) -> str:
    return f"list_has_any({tags}, [{', '.join(map(q, some))}])"


def names(some: list[str]) -> str:
    return "[" + ", ".join(map(q, some)) + "]"


def pts(cond: str, n: int) -> str:
    return f"(case when {cond} then {n} else 0 end)"


_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: White space as Python's split() has it.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def unescaped(expr: str) -> str:
    """Character references as HTML5 reads them: named ones, the old names without a semicolon by their longest, and numbers."""
    pairs = lambda found: "map {" + ", ".join(f"{q(k) if isinstance(k, str) else k}: {q(v)}" for k, v in found.items()) + "}"
    named = html.entities.html5
    old = {n: c for n, c in named.items() if not n.endswith(";")}
    odd = {n: html.unescape(f"&#{n};") for n in [0, 13, *range(1, 9), 11, *range(14, 32), *range(127, 160)]}
    longest = f"list_sort(list_filter({names(list(old))}, lambda n: starts_with(s, n)), 'desc')[1]"  # of prefixes of one text the longest sorts last
    number = "try_cast(case when lower(s[2]) = 'x' then '0x' || rtrim(s[3:], ';') else rtrim(s[2:], ';') end as bigint)"
    point = f"list_transform([{number}], lambda n: case when n is null or n > 1114111 or n between 55296 and 57343 then chr(65533) when n between 64976 and 65007 or n % 65536 >= 65534 then '' else coalesce({pairs(odd)}[n], chr(n::int)) end)[1]"
    name = f"coalesce({pairs(named)}[s], list_transform([{longest}], lambda k: {pairs(old)}[k] || s[len(k) + 1:])[1], '&' || s)"
    one = f"list_transform([r[2:]], lambda s: case when s[1] = '#' then {point} else {name} end)[1]"
    return f"list_aggregate(list_transform(list_zip(string_split_regex({expr}, {q(_REFERENCE)}), regexp_extract_all({expr}, {q(_REFERENCE)})), lambda p: p[1] || coalesce(list_transform([p[2]], lambda r: {one})[1], '')), 'string_agg', '')"


def literal(x) -> str:
    return "null" if x is None else q(x) if isinstance(x, str) else names(x) if isinstance(x, list) else str(x).lower() if isinstance(x, bool) else str(x)


RAW = f"""
o as (select o_orderkey as k, o_orderkey // 3 as g, o_orderkey % 3 as v from orders),
raw_listing as (select k as ingest_seq, 'src' || (case when v = 1 then 1 else 0 end) as source_id,
  {names(fx.SOURCES)}[(g + case when v = 1 then 1 else 0 end) % 3 + 1] as source_name,
  'https://src' || (case when v = 1 then 1 else 0 end) || '.example.org/e/' || g as source_url,
  {names(fx.TITLES)}[g % 16 + 1] || ' ' || (g // 16) as title,
  strftime(timestamp '2024-01-01' + to_days(cast(g % 60 as integer)) + to_hours(g % 24), '%Y-%m-%d %H:%M:%S') as start_text,
  nullif({names(fx.PLACES)}[g % 8 + 1], '') as location_text,
  case when (v + g) % 4 <> 0 then 'Songs, crafts and stories for families. Item ' || g || '.' end as summary_text,
  nullif({names(fx.PRICES)}[(g // 16) % 12 + 1], '') as price_text from o)"""

_STREET = r",\s*\d{1,5}\s+[A-Z]"
_PLACE = f"""
place as (select *, cast(start_text as timestamp) as start, summary_text as summary,
  case when regexp_matches(location_text, '{_STREET}') then regexp_extract(location_text, '^(.*?){_STREET}', 1) else location_text end as location_name,
  case when regexp_matches(location_text, '{_STREET}') then regexp_extract(location_text, ',\\s*(\\d{{1,5}}\\s+[A-Z].*)$', 1) end as location_address,
  case {' '.join(f"when {words('location_text', ws)} then {q(c)}" for c, ws in rules.COUNTIES.items())} end as county,
  case {' '.join(f"when contains(lower(location_text), {q(w)}) then {q(w.title())}" for ws in rules.COUNTIES.values() for w in ws)} end as city from raw_listing)"""

_T = "text"
_LIB = f"({words('source_name', rules.LIBRARY_NAMES)} or {words('source_url', rules.LIBRARY_URLS)} or {words('location_name', rules.LIBRARY_VENUES)})"
_PUB = f"({words('source_name', rules.PUBLIC_NAMES)} or {words('location_name', rules.PUBLIC_VENUES)})"
_WEAK = rx(f"regexp_replace({_T}, {q('(?i)' + rules.PAID_FALSE_ALARMS)}, ' ', 'g')", rules.WEAK_PAID)
REASON = f"""case when lower(trim(price_text)) in ({', '.join(map(q, rules.ZERO_PRICES))}) then 'zero_cost_value'
  when text = '' and {_LIB} then 'library_default_free_no_context' when text = '' and {_PUB} then 'public_source_default_free_no_context' when text = '' then 'no_context'
  when {rx(_T, rules.MIXED)} then 'mixed_pricing' when {rx(_T, rules.DONATION)} then 'donation_language' when {rx(_T, rules.STRONG_PAID)} then 'strong_paid_signal' when {rx(_T, rules.DOLLAR)} then 'dollar_amount'
  when {rx(_T, rules.EXPLICIT_FREE)} then (case when {_WEAK} then 'conflicting_free_and_paid' else 'explicit_free_text' end) when {_WEAK} then 'weak_paid_signal'
  when ({_LIB} or {_PUB}) and {rx(_T, rules.PAID_PROGRAM)} then 'paid_program_format_no_price' when {_LIB} then 'library_default_free' when {_PUB} then 'public_source_default_free'
  when {rx(_T, chr(92) + 'bfree' + chr(92) + 'b')} then 'free_word_only' else 'unknown_no_signals' end"""
_FREE = "('zero_cost_value','library_default_free_no_context','public_source_default_free_no_context','explicit_free_text','library_default_free','public_source_default_free','free_word_only')"
_UNKNOWN = "('no_context','paid_program_format_no_price','unknown_no_signals')"
PRICED = f"""
texted as (select *, trim(concat_ws(' ', price_text, summary, title)) as text from place),
reasoned as (select *, {REASON} as reason from texted),
priced as (select *, case when reason in {_FREE} then 'free' when reason in {_UNKNOWN} then 'unknown' when reason = 'donation_language' then 'suggested_donation' else 'paid' end as cost_type,
  case when reason in {_FREE} then 'free' when reason in {_UNKNOWN} then 'unknown' when reason = 'donation_language' then 'donation' when reason in ('mixed_pricing','conflicting_free_and_paid') then 'mixed' else 'paid' end as price_type,
  case when reason in {_FREE} then true when reason in {_UNKNOWN} then null else false end as is_free from reasoned)"""


def _held(body: str, some: list[str], not_before: dict[str, str]) -> str:
    """Whether a text holds an alternative; where one must not be followed by something, those places are blanked for it alone."""
    plain = [a for a in some if a not in not_before]
    blanked = [rx(f"regexp_replace({body}, {q(rf'(?i)\b(?:{a}){not_before[a]}')}, ' ', 'g')", rules.pattern([a])) for a in some if a in not_before]
    return "(" + " or ".join([*([rx(body, rules.pattern(plain))] if plain else []), *blanked]) + ")"


def _tag(t: str, some: list[str]) -> str:
    return f"case when {_held('words_text', some, rules.TAG_NOT_BEFORE)} then {q(t)} end"


TAGGED = f"""
worded as (select *, concat_ws(' ', title, summary, location_name) as words_text from priced),
tags0 as (select *, list_sort(list_distinct(list_filter([{', '.join(_tag(t, s) for t, s in rules.TAGS.items())},
  case when cost_type = 'free' then 'free' end, case when isodow(start) >= 6 then 'weekend' else 'weekday' end,
  case when hour(start) between 5 and 11 then 'morning' when hour(start) between 12 and 16 then 'afternoon' when hour(start) between 17 and 21 then 'evening' end], lambda x: x is not null))) as found from worded),
clash as (select *, list_contains(found, 'indoor') and list_contains(found, 'outdoor') as both_set,
  {words('location_name', rules.INDOOR_VENUE_WORDS)} as vin, {words('location_name', rules.OUTDOOR_VENUE_WORDS)} as vout,
  {rx("concat_ws(' ', title, summary)", rules.pattern(rules.INDOOR_TEXT))} as tin, {rx("concat_ws(' ', title, summary)", rules.pattern(rules.OUTDOOR_TEXT))} as tout from tags0),
tagged as (select *, case when not both_set then found when vin and not vout then list_filter(found, lambda x: x <> 'outdoor') when vout and not vin then list_filter(found, lambda x: x <> 'indoor')
  when tin and not tout then list_filter(found, lambda x: x <> 'outdoor') when tout and not tin then list_filter(found, lambda x: x <> 'indoor') else found end as tags from clash)"""

_FF = f"""(case when {any_of('tags', rules.AGE_TAGS)} then 30 when list_contains(tags, 'teen') then -10 else 0 end) + {pts(any_of('tags', rules.KID_VENUE_TAGS), 20)} + {pts("list_contains(tags, 'free')", 15)} + {pts("list_contains(tags, 'indoor')", 10)}
 + {pts(any_of('tags', rules.ENRICHING_TAGS), 10)} + {pts("list_contains(tags, 'weekend')", 10)} + {pts(words('title', rules.KID_TITLE_WORDS), 10)} + {pts(words('location_name', rules.KID_VENUE_WORDS), 10)} + {pts('rainy', 5)} + {pts('summary is not null', 5)}"""


def _first(table: dict[str, str]) -> str:
    return "case " + " ".join(f"when {rx('body', rules.pattern(s))} then {q(n)}" for n, s in table.items()) + " end"


def _adult(n: str, some: list[str]) -> str:
    return f"case when {_held('body', some, rules.ADULT_NOT_BEFORE)} then {q(n)} end"


SCORED = f"""
rained as (select *, list_contains(tags, 'virtual') or (list_contains(tags, 'indoor') and not list_contains(tags, 'outdoor')) as rainy, concat_ws(' ', title, summary) as body from tagged),
ruled as (select *, {_first(rules.FAMILY_RULES)} as family, {_first(rules.ACTIVITY_RULES)} as activity, list_filter([{', '.join(_adult(n, s) for n, s in rules.ADULT_RULES.items())}], lambda x: x is not null) as adult, {_first(rules.RESCUE_RULES)} as rescue,
  least(greatest({_FF}, 0), 100) / 100.0 as family_friendly_score, list_sort(list_intersect(tags, {names(rules.AGE_TAGS)})) as ages from rained),
summed as (select *, least(greatest(45 + (case when len(ages) > 0 then 30 when list_contains(tags, 'teen') then 10 else 0 end) + (case when family is not null then 25 else 0 end) + (case when activity is not null then 12 else 0 end)
  - 50 * len(adult) + (case when len(adult) > 0 and rescue is not null then 35 else 0 end), 0), 100) as points from ruled),
scored as (select *, points / 100.0 as family_relevance_score, case when points >= 65 then 'family' when points >= 45 then 'parent_oriented' when points >= 30 then 'neutral' else 'adult_service' end as family_relevance_label,
  substr(sha256(lower(title) || '|' || strftime(start, '%Y-%m-%dT%H:%M:%S') || '|' || coalesce(lower(location_name), '') || '|' || source_url), 1, 16) as id from summed)"""
EVENTS = ",".join([RAW, _PLACE, PRICED, TAGGED, SCORED])
UPCOMING = f"up as (select * from scored where cast(start as date) >= date '{fx.AS_OF}')"
_Q = "round(((case when summary is not null then 25 else 0 end) + (case when location_name is not null then 10 else 0 end) + 5 * least(len(tags), 4) + 10 * family_friendly_score) / 100.0, 6)"
SURVIVORS = f"""{UPCOMING},
rated as (select *, {_Q} as quality, min(ingest_seq) over (partition by id) as group_seq from up),
once as (select * from rated qualify row_number() over (partition by id order by quality desc, ingest_seq) = 1),
survivors as (select * from once qualify row_number() over (partition by lower(title), cast(start as date), coalesce(lower(location_name), '') order by quality desc, group_seq) = 1)"""


def events(select: str) -> str:
    return f"with {EVENTS} {select}"


def survivors(select: str) -> str:
    return f"with {EVENTS}, {SURVIVORS} {select}"


def raw(select: str) -> str:
    return f"with {RAW} {select}"


SCHEDULES = f"""
p as (select p_partkey as k, p_size as size, date '2024-01-01' + cast(p_partkey % 90 as integer) as d from part),
entries as (select *, k % 4 = 1 as dated, d + (case when k % 41 = 7 then -2 else size % 14 end) as e, k % 61 = 5 as untitled, k % 29 = 0 as disabled,
  case when k % 5 = 0 then ['sat','sun'] when k % 5 = 1 then ['mon','wed'] when k % 50 = 3 then ['som'] end as codes from p),
coded as (select *, case when untitled then 'missing_title' when not dated and e < d then 'reversed_run' when not dated and codes is not null and list_contains(codes, 'som') then 'unknown_weekday' end as code from entries where not disabled),
runs as (select k, cast(unnest(generate_series(d, e, interval 1 day)) as date) as day, codes from coded where code is null and not dated),
days as (select k, day, case when k % 3 = 0 then '10:00:00' end as from_time, case when k % 6 = 0 then '14:30:00' end as to_time, null as note from runs where codes is null or list_contains(codes, ['mon','tue','wed','thu','fri','sat','sun'][isodow(day)])
  union all select k, d, '09:00:00', null, 'Opening day.' from coded where code is null and dated union all select k, d + 7, null, null, null from coded where code is null and dated)"""

CANDIDATES = f"""
o as (select o_orderkey as k from orders),
cand as (select k, 'https://{urls.AGGREGATOR}/event/' || k as seed_url, {names(fx.TITLES)}[k % 16 + 1] || ' ' || k as discovered_title,
  case when k % 5 = 0 then null when k % 5 = 1 then 'soon' else cast(date '2024-01-01' + cast(k % 60 as integer) as varchar) end as discovered_date_text, nullif({names(fx.PLACES)}[k % 8 + 1], '') as discovered_location_text,
  case when k % 3 = 0 then 'https://hub.example.com/all' when k % 7 = 1 then null when k % 11 = 2 then 'https://{urls.AGGREGATOR}/x' when k % 13 = 3 then 'https://www.facebook.com/' || k
    else 'http' || (case when k % 2 = 0 then 's' else '' end) || '://site' || (k % 50) || '.example.net/' || k end as url,
  case when k % 17 = 0 then 'rejected' when k % 19 = 0 then 'published' else 'discovered' end as status from o),
identified as (select *, substr(sha256(seed_url || '|' || lower(discovered_title)), 1, 16) as candidate_id from cand)"""

CACHE = "cache as (select * from (values " + ", ".join("(" + ", ".join([q(r[0]), *("null::double" if x is None else str(x) for x in r[1:4]), f"timestamp '{r[4]}'"]) + ")" for r in fx.CACHE) + ") t(query, latitude, longitude, confidence, resolved_at))"
AREA = f"latitude between {rules.SERVICE_AREA[0]} and {rules.SERVICE_AREA[1]} and longitude between {rules.SERVICE_AREA[2]} and {rules.SERVICE_AREA[3]}"
_REGION = "case lower(county) " + " ".join(f"when {q(k)} then {q(v)}" for k, v in regions.COUNTY_REGIONS.items()) + " end"
#: Queries for places that are not virtual; the fixture's names need no clean-up.
ASKED = f"""
asked as (select ingest_seq, location_name, list_filter([location_address || ', ' || city, location_address, location_name || ', ' || city || ', ' || county || ' County, VA', location_name || ', ' || city || ', VA', location_name || ', ' || {_REGION}, location_name], lambda x: x is not null) as found from scored),
listed as (select ingest_seq, list_filter(found, lambda x, i: list_position(found, x) = i) as queries from asked)"""
RESOLVED = f"""{CACHE},
steps as (select ingest_seq, unnest(queries) as query, generate_subscripts(queries, 1) as pos from listed),
met as (select s.ingest_seq, s.pos, s.query, c.query is not null as known, c.latitude, c.longitude, c.confidence, coalesce({AREA}, false) as good from steps s left join cache c on s.query = c.query),
agg as (select ingest_seq, min(pos) filter (good) as hit_pos, min(pos) filter (not known) as gap, arg_min(latitude, pos) filter (good) as lat, arg_min(longitude, pos) filter (good) as lon from met group by 1),
resolved as (select l.ingest_seq, len(l.queries) as n, case when len(l.queries) = 0 then 'no_query' when hit_pos is not null and (gap is null or hit_pos < gap) then 'hit' when gap is not null then 'pending' else 'failed' end as status, lat, lon from listed l left join agg a using (ingest_seq))"""

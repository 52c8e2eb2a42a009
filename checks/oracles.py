"""DuckDB SQL for the registered queries.

Nothing here parses a link: coordinates, types and regions come from the integer keys in
closed form, and plain text and points of interest from the raw text of ``documents``, by kind of markup.
"""

from __future__ import annotations

from checks import fixtures as fx

_M = "k % 12"
_KEPT = f"{_M} not in (7, 9, 10, 11)"

ITEMS = f"""
orders_kc as (select o_orderkey as k, o_custkey as c from orders),
items as (
    select k, {fx.LINK_LANG} as lang, 0 as sub, {fx.GEO_TUPLE} as item from orders_kc
    union all
    select k, {fx.LINK_LANG} as lang, 1 as sub, {fx.PLAIN_TUPLE} as item from orders_kc where k % 3 = 0
),
placed as (
    select k, lang, sub, item, {fx._div('k', fx.TUPLES_PER_LINE)} as line_ord,
        row_number() over (partition by lang, {fx._div('k', fx.TUPLES_PER_LINE)} order by k, sub) - 1 as pos,
        count(*) over (partition by lang, {fx._div('k', fx.TUPLES_PER_LINE)}) as n
    from items
),
tuples as (
    select k, sub, line_ord, cast(pos as integer) as pos,
        case when pos = 0 then 'INSERT INTO x VALUES (' else '' end || item ||
        case when pos = n - 1 then ');' else '' end as tuple
    from placed
)"""


def _degrees(d: str, m: str, s: str, d10: str) -> str:
    """Degrees by layout: whole degrees, minutes, tenths of seconds, tenths of degrees."""
    return f"""case when {_M} in (0, 1)
            then cast({d} as double) + cast({m} as double) / 60
                + (cast({s} as double) / 10) / 3600
        when {_M} in (2, 3) then cast({d} as double) + cast({m} as double) / 60
        else cast({d10} as double) / 10 end"""


LINKS = f"""
orders_kc as (select o_orderkey as k, o_custkey as c from orders),
fields as (
    select k, c, {fx.LINK_LANG} as lang, {fx.title_of('c')} as title, 'en' as language,
        case {_M} when 1 then 'city' when 3 then 'landmark' when 6 then 'City'
            when 7 then 'city' when 8 then 'country' else '' end as poitype,
        case {_M} when 1 then 'US-CA' when 3 then 'NL' when 6 then 'DE-BY'
            when 7 then 'XYZ' else '' end as region,
        case when {_M} in (0, 1) then 'DMS' when {_M} in (2, 3) then 'DM'
            when {_M} in (4, 5, 6, 8) then 'DEC' end as layout,
        case when {fx._div('k', 12)} % 2 = 0 then 1.0 else -1.0 end as ns,
        case when {fx._div('k', 24)} % 2 = 0 then 1.0 else -1.0 end as ew
    from orders_kc
),
valued as (
    select *,
        case when {_M} = 8 then null
            else {_degrees('k % 90', 'c % 60', 'k % 599', '(k % 90) * 10 + c % 10')}
                * cast(ns as double) + 0.0 end as latitude,
        case when {_M} = 8 then 1234567.0
            else {_degrees('c % 180', 'k % 60', 'c % 599', '(c % 180) * 10 + k % 10')}
                * cast(ew as double) + 0.0 end as longitude
    from fields
),
links as (select * from valued where {_KEPT}),
last_links as (
    select * from links qualify row_number() over (partition by lang, title order by k desc) = 1
)"""

ARTICLES = f"""
articles as (
    select lang, {fx.WIKI} as wiki, doc_id as page_id, {fx.ARTICLE_TITLE} as title, text,
        {fx.body_of()} as body
    from documents
)"""

JOINED = f"""{LINKS},{ARTICLES},
joined as (
    select a.*, l.latitude, l.longitude, l.poitype, l.region
    from articles a join last_links l on a.title = l.title and a.lang = l.lang
)"""

_URL = "'Wikipedia: ' || ' http://' || lang || '.wikipedia.org/wiki/' || replace(title, ' ', '_')"
_REMARKS = f"""'(' || {_URL} || case when poitype <> '' then ' ; Type: ' || poitype else '' end
    || case when region <> '' then ' ; Country_Region: ' || region else '' end || ')'"""
_COUNTRY = """case region when 'US-CA' then 'US' when 'DE-BY' then 'DE' when 'NL' then 'NL'
    else case when region = '' and poitype = 'country' then 'country' else '' end end"""
_REGION = "case region when 'US-CA' then 'CA' when 'DE-BY' then 'BY' else '' end"
_CITY = "case when poitype in ('city', 'City') then title else '' end"


def _entities(x: str) -> str:
    return (
        f"replace(replace(replace(replace({x}, '&amp;', '&'), '&gt;', '>'), '&lt;', '<'),"
        " 'nbsp;', ' ')"
    )


def _squeeze(x: str) -> str:
    spaces = r"[ \t\r\n]+"
    return f"trim(regexp_replace({x}, '{spaces}', ' ', 'g'))"


def _cut(x: str) -> str:
    return f"regexp_extract({x}, '(?s)^(.*\\.)', 1)"


# The readable text of each kind of body, without looking at its markup.
_READABLE = """case page_id % 6 when 0 then text when 1 then text
    when 2 then 'Bold first and Second. ' || text when 3 then text || ' Head'
    when 4 then text || ' label' end"""
_PLAIN = f"case when page_id % 6 = 5 then {fx.REDIRECT_WORD} || ' Place 1' else {_squeeze(_entities(_READABLE))} end"
_CONTENT = _cut(f"replace(substring({_squeeze(_entities(_READABLE))}, 1, 600), '|', '')")

POI = f"""{JOINED},
poi as (
    select wiki, lang, page_id, title as NAME, latitude as LATITUDE, longitude as LONGITUDE,
        {_COUNTRY} as COUNTRY, {_REGION} as REGION, {_CITY} as CITY, {_REMARKS} as REMARKS,
        {_CONTENT} as CONTENT
    from joined where page_id % 6 <> 5 and body <> ''
)"""
_POI_COLUMNS = "NAME, LATITUDE, LONGITUDE, COUNTRY, REGION, CITY, REMARKS, CONTENT"


def _degrees_text(x: str) -> str:
    fixed = f"cast(try_cast({x} as decimal(12, 7)) as varchar)"
    return f"coalesce({fixed}, cast({x} as varchar), '')"


def _sql_text(x: str) -> str:
    return f"'''' || replace({x}, '''', '''''') || ''''"


def _sql_number(x: str) -> str:
    return f"coalesce(cast({x} as varchar), 'NULL')"


_NODES = f"""{POI},
nodes as (
    select *, row_number() over (partition by wiki, lang order by page_id) * 10 + 1 as node_id
    from poi
)"""
_TAG_VALUES = [
    ("tourism", "'user'"),
    ("name", "NAME"),
    ("addr:country", "COUNTRY"),
    ("addr:province", "case when COUNTRY <> 'US' then REGION else '' end"),
    ("addr:state", "case when COUNTRY = 'US' then REGION else '' end"),
    ("addr:city", "CITY"),
    ("note", "REMARKS || ' ' || CONTENT"),
]
_TAGS = _NODES + ",\ntags as (" + "\n    union all\n".join(
    f"    select wiki, lang, page_id, node_id, '{k}' as k, {v} as v from nodes"
    for k, v in _TAG_VALUES
) + ")"


def oracles() -> dict[str, str]:
    link_values = "title, latitude, longitude, language, poitype, region"
    match_values = "page_id, wiki, lang, title, latitude, longitude, poitype, region"
    normal = "replace(title, '_', ' ')"
    poi_all = f"with {POI} select wiki, lang, page_id, {_POI_COLUMNS} from poi"
    head = "replace(substring(text, 1, 600), '|', '')"
    return {
        "link_tuples": f"with {ITEMS} select line_ord, pos, tuple from tuples",
        "geo_link_filter": f"""with {ITEMS} select line_ord, pos, tuple from tuples
            where sub = 0 and {_M} <> 11""",
        "link_fields": f"""with {LINKS} select k, {fx.encoded_title_of('c')} as title_raw, language,
            case {_M} when 0 then 8 when 1 then 10 when 2 then 6 when 3 then 8 when 4 then 4
                when 5 then 4 when 6 then 6 when 7 then 8 when 8 then 5 when 9 then 2 end as n_tokens,
            poitype, region from fields where {_M} <> 11""",
        "coord_layout": f"with {LINKS} select k, layout from fields where {_M} <> 11",
        "coord_values": f"""with {LINKS} select k, layout,
            case when {_KEPT} then latitude end as latitude,
            case when {_KEPT} then longitude end as longitude from valued where {_M} <> 11""",
        "title_decode": f"""select o_orderkey as k, {fx.title_of('o_custkey')} as title
            from orders""",
        "geo_links": f"with {LINKS} select k, {link_values} from links",
        "geo_links_strict": f"with {LINKS} select k, {link_values} from links where {_M} <> 8",
        "geo_links_extended": f"""with {LINKS} select k, {link_values} from valued
            where {_KEPT} or {_M} = 7""",
        "links_keep_last": f"with {LINKS} select k, {link_values} from last_links",
        "links_keep_last_window": f"with {LINKS} select k, {link_values} from last_links",
        "pages_keep_last": """select page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) as title
            from pages qualify row_number() over (partition by title order by page_id desc) = 1""",
        "link_scan_counts": f"""with {ITEMS} select lang, count(*) as tuples,
            count(*) filter (where sub = 0 and {_KEPT}) as kept from items group by lang""",
        "link_reject_reasons": f"""with {ITEMS} select lang,
            case when sub = 1 then 'not_geo' when {_M} = 11 then 'corrupt'
                when {_M} = 10 then 'no_params' when {_M} in (7, 9) then 'layout'
                else 'kept' end as reason, count(*) as tuples from items group by 1, 2""",
        "coord_quality": f"""with {LINKS} select layout, count(*) as links,
            count(*) filter (where {_M} = 8) as bad_latitude, 0 as bad_longitude,
            0 as out_of_range, count(*) filter (where {_M} <> 8) as valid
            from links group by layout""",
        "link_sql_inserts": f"""with {LINKS} select lang, title,
            'insert into ' || lang || '_externallinks values (' || {_sql_text('title')} || ',' ||
            {_sql_number('latitude')} || ',' || {_sql_number('longitude')} || ',' ||
            {_sql_text('language')} || ',' || {_sql_text('poitype')} || ',' ||
            {_sql_text('region')} || ');' as line from last_links""",
        "dump_file_catalog": f"""select doc_id, {fx.DUMP_PATH} as path,
            case when doc_id % 3 < 2 then lang end as lang,
            case when doc_id % 3 < 2 then {fx.WIKI} end as wiki,
            case doc_id % 3 when 0 then 'articles' when 1 then 'links' end as content,
            case when doc_id % 3 < 2 then lang || 'wiki-latest-externallinks.sql.gz' end as link_dump
            from documents""",
        "language_labels": f"""with d as (select doc_id, {fx.MANY_LANGUAGES} as lang from documents)
            select doc_id, lang,
            case when lang in ('es', 'simple') then 'en' else lang end as label_code,
            case lang when 'nl' then 'Artikel url: ' when 'de' then 'Artikel url: '
                when 'fr' then 'URL de l''article: ' when 'no' then 'artikkelen url: '
                when 'cs' then 'článek url: ' when 'pl' then 'artykuł url: '
                when 'ja' then '記事のURL: ' when 'ru' then 'Статья URL: '
                else 'Article url: ' end as article_label,
            case lang when 'ja' then 'ウィキペディア' when 'ru' then 'Википедия'
                else 'Wikipedia: ' end as wiki_label from d""",
        "language_catalogue": f"""with d as (
            select doc_id, {fx.WIKI} as wiki, {fx.MANY_LANGUAGES} as lang from documents)
            select doc_id, wiki, lang from d
            where wiki = 'wikipedia' or lang not in ('ja', 'no', 'cs', 'simple')""",
        "article_scan": f"with {ARTICLES} select lang, wiki, page_id, title, body from articles",
        "article_body": f"""with {ARTICLES} select page_id, title, body from articles
            where page_id % 6 <> 5 and body <> ''""",
        "infobox_strip": f"""with {ARTICLES} select page_id, case when page_id % 6 = 1
            then chr(10) || chr(10) || text else body end as stripped from articles""",
        "article_plain_text": f"""with {ARTICLES} select page_id, {_PLAIN} as plain
            from articles""",
        "content_truncate": f"""select doc_id, replace(case when doc_id % 8 = 0
            then 'xy' || chr(92) || 'n' || chr(34) || 'z' || substring(text, 1, 591)
            else substring(text, 1, 600) end, '|', '') as head from documents""",
        "content_sentence_cut": f"select doc_id, {_cut(head)} as sentences from documents",
        "article_content": f"""with {ARTICLES} select page_id, {_CONTENT} as content from articles
            where page_id % 6 <> 5 and body <> ''""",
        "infobox_website": f"""with {ARTICLES} select page_id, case when page_id % 6 = 1
            then 'http://w.example/' || cast(page_id as varchar) else '' end as website
            from articles""",
        "article_link_join": f"with {JOINED} select {match_values} from joined",
        "article_link_join_normalized": f"""with {LINKS},{ARTICLES},
            last_normal as (select * replace ({normal} as title) from links
                qualify row_number() over (partition by lang, {normal} order by k desc) = 1)
            select a.page_id, a.wiki, a.lang, {normal.replace('title', 'a.title')} as title,
                l.latitude, l.longitude, l.poitype, l.region
            from articles a join last_normal l
            on {normal.replace('title', 'a.title')} = l.title and a.lang = l.lang""",
        "unmatched_articles": f"""with {LINKS},{ARTICLES} select page_id, title from articles a
            where not exists (select 1 from last_links l where l.title = a.title and l.lang = a.lang)""",
        "unmatched_links": f"""with {LINKS},{ARTICLES} select k, title from last_links l
            where not exists (select 1 from articles a where l.title = a.title and l.lang = a.lang)""",
        "match_rate": f"""with {LINKS},{ARTICLES}, flagged as (
            select lang, exists (select 1 from last_links l where l.title = a.title and l.lang = a.lang) as hit
            from articles a)
            select lang, count(*) as articles, count(*) filter (where hit) as matched,
            count(*) filter (where hit) / count(*) as rate from flagged group by lang""",
        "poi_from_files": poi_all,
        "dump_namespaces": f"""with d as (select doc_id, {fx.MANY_LANGUAGES} as lang from documents),
            words as (select * from (values ('ja', 'ファイル'), ('ja', '画像'), ('ja', 'カテゴリ'), ('ru', 'файл'),
                ('ru', 'изображение'), ('ru', 'категория'), ('nl', 'bestand'), ('nl', 'afbeelding'), ('nl', 'categorie'),
                ('no', 'fil'), ('no', 'bilde'), ('no', 'kategori'), ('cs', 'soubor'), ('cs', 'obrázek'), ('cs', 'kategorie'),
                ('pl', 'plik'), ('pl', 'grafika'), ('pl', 'kategoria'), ('de', 'datei'), ('de', 'bild'), ('de', 'kategorie'),
                ('fr', 'fichier'), ('fr', 'catégorie'), ('es', 'archivo'), ('es', 'imagen'), ('es', 'categoría')) as t(lang, word))
            select doc_id, lang, word from d join words using (lang)
            union all select doc_id, lang, word from d, (values ('file'), ('image'), ('category')) as t(word)""",
        "poi_url": f"with {ARTICLES} select page_id, {_URL} as url from articles",
        "poi_city": f"with {JOINED} select page_id, {_CITY} as CITY from joined",
        "poi_country_region": f"""with {LINKS} select k,
            case region when 'XYZ' then '' else {_COUNTRY} end as COUNTRY, {_REGION} as REGION
            from fields where {_M} <> 11""",
        "poi_remarks": f"with {JOINED} select page_id, {_REMARKS} as REMARKS from joined",
        "poi": poi_all,
        "poi_from_dumps": poi_all,
        "poi_all_wikis": poi_all,
        "links_from_files": f"""with {LINKS} select lang, {link_values} from last_links""",
        "poi_clean": f"{poi_all} where CONTENT <> ''",
        "poi_counts": f"with {POI} select wiki, lang, count(*) as pois from poi group by 1, 2",
        "poi_export": f"""with {POI} select wiki, lang, page_id, NAME, LATITUDE, LONGITUDE, COUNTRY,
            REGION, CITY, REMARKS, CONTENT || ' A & B' as CONTENT from poi where wiki = 'wikivoyage'""",
        "poi_gpx_waypoints": f"""with {POI} select wiki, lang, {_degrees_text('LATITUDE')} as lat,
            {_degrees_text('LONGITUDE')} as lon, NAME as name, REMARKS || ' ' || CONTENT as description
            from poi""",
        "poi_osm_nodes": f"""with {_TAGS} select wiki, lang, node_id,
            {_degrees_text('any_value(n.LATITUDE)')} as lat,
            {_degrees_text('any_value(n.LONGITUDE)')} as lon,
            cast(count(*) filter (where t.v <> '') as integer) as tags
            from nodes n join tags t using (wiki, lang, page_id, node_id)
            group by wiki, lang, page_id, node_id""",
        "poi_osm_tags": f"with {_TAGS} select wiki, lang, node_id, k, v from tags where v <> ''",
        "poi_sql_inserts": f"""with {POI} select wiki, lang, page_id,
            'insert into ' || lang || '_' || wiki || ' (TITLE, LATITUDE, LONGITUDE, COUNTRY, REGION, CITY, REMARKS, CONTENT)'
            || ' values (' || {_sql_text('NAME')} || ',' ||
            {_sql_number('LATITUDE')} || ',' || {_sql_number('LONGITUDE')} || ',' ||
            {_sql_text('COUNTRY')} || ',' || {_sql_text('REGION')} || ',' || {_sql_text('CITY')}
            || ',' || {_sql_text('REMARKS')} || ',' || {_sql_text('CONTENT')} || ');' as line
            from poi""",
        "poi_csv_roundtrip": f"with {POI} select wiki, lang, {_POI_COLUMNS} from poi",
        "csv_integrity": f"""with {POI} select wiki, lang,
            count(*) filter (where page_id % 13 <> 0) as correct_rows,
            count(*) filter (where page_id % 13 = 0) as wrong_rows,
            count(*) as lines from poi group by 1, 2""",
    }

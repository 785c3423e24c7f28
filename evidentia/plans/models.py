"""Extraction jobs over stored pages: machine pages with every outcome, and glossaries in three layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import parse
from evidentia.operators import records
from evidentia.plans import table
from evidentia.sources import tables

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _join(*parts):
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _machine_pages(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A page and its stored bytes for every part, in all forms: nested in layout tables or not, images, two files, unknown labels, three kinds of dates, foreign,
    blank, repeated and other pages. The pages of a twelfth do not say where their bytes are; no bytes are left out."""
    k, part = F.col("p_partkey"), table(spark, sf, "part")
    shown = F.when(k % 12 == 5, k + 1).when(k % 12 == 9, k - 9).otherwise(k)  # whose page it is
    head = _join("<tr><td colspan=5><a href='machine.cgi?id=", shown, "'><b>", F.col("p_name"), "</b></a> Cat No. ", shown, " <i>", F.when(k % 5 != 0, _join("/ March, ", k % 50 + 1950)).otherwise(F.lit("")), " / ", k % 4 + 1, " Players</i></td></tr>")
    maker = _join("<tr><td><b>Manufacturer: </b></td><td colspan=4>", F.col("p_brand"), "</td></tr>")
    made = F.when(k % 4 == 0, _join("<tr><td><b>Date Of Manufacture:</b></td><td>May ", k % 28 + 1, ", ", k % 40 + 1960, "</td></tr>")).otherwise(F.lit(""))
    planned = F.when(k % 4 <= 1, _join("<tr><td><b>Project Date:</b></td><td>", k % 40 + 1955, "</td></tr>")).otherwise(F.lit(""))
    colour = F.when(k % 6 == 0, _join("<tr><td><b>Cabinet Colour:</b></td><td>", F.col("p_type"), "</td></tr><tr><td>Plain:</td><td>no label</td></tr>")).otherwise(F.lit(""))
    people = F.when(k % 2 == 0, F.lit("<a href='search.pl?ppl=Ann'>Ann Arc</a>, <a href='search.pl?ppl=Bo'>Bo</a> (<a href='help'>?</a>)")).otherwise(F.lit("Cy Dee, , Eve"))
    credits = _join("<tr><td><b>Design by: </b></td><td>", people, "</td></tr>")
    files = _join(
        "<tr><td><b>ROMs: </b></td><td>", F.col("p_size"), " KB</td><td>ZIP</td><td><a href='/f/", k, ".zip'>rom ", k, "</a></td><td>[Ann]</td></tr>",
        "<tr><td>&nbsp;</td><td></td><td>PDF</td><td><a href='/f/", k, ".pdf'>sheet</a></td><td>Bo</td></tr><tr><td></td><td></td><td></td><td>withheld</td><td></td></tr>",
    )
    late = F.when(k % 3 == 0, F.lit("<tr><td><b>Notes:</b></td><td>x</td></tr><tr><td></td><td>1</td><td>2</td><td><a href='stray'>stray</a></td><td></td></tr>")).otherwise(F.lit(""))
    images = F.when(k % 3 == 1, _join("<tr><td><b>Images: </b></td><td><table><tr><td><img src='/i/tn_", k, ".jpg' alt='Front'><br>320 x ", k % 90 + 200, "<br>(Eve)</td><td>none</td></tr></table></td></tr>")).otherwise(F.lit(""))
    body = _join("<table>", head, maker, made, planned, colour, credits, files, late, images, "</table>")
    page = F.when(k % 3 == 0, _join("<table><tr><td>menu</td><td>", body, "</td></tr></table>")).otherwise(body)
    page = F.when(k % 12 == 7, F.lit(" \n ")).when(k % 12 == 8, _join("<p>see <a href='machine.cgi?id=", k, "'>this</a></p><table><tr><td><b>News:</b></td><td>x</td></tr></table>")).otherwise(page)
    url = F.when(k % 12 == 9, _join("https://h/other/", k)).otherwise(_join("https://h/machine.cgi?id=", k))
    sha = F.sha2(_join("page ", k), 256)
    return part.select(k.alias("page_id"), url.alias("url"), F.when(k % 12 != 10, sha).alias("content_sha")), part.select(k.alias("page_id"), sha.alias("content_sha"), page.alias("content"))


@query("""
with p as (select p_partkey as k, p_partkey % 12 as f, * from part),
o as (select *, case when f = 10 then 'no blob' when f = 7 then 'unreadable' when f = 8 then 'not a model' when f = 5 then 'id differs' when f = 9 and k >= 9 and exists (select 1 from part q where q.p_partkey = p.k - 9) then 'duplicate id' else 'ok' end as outcome from p),
d as (select *, case when outcome = 'ok' then true end as ok, case when k % 4 = 0 then (k % 40 + 1960) || '-5-' || (k % 28 + 1) end as made, case when k % 4 <= 1 then (k % 40 + 1955)::varchar end as planned, case when k % 5 <> 0 then (k % 50 + 1950) || '-3' end as head from o)
select k as page_id, outcome, case when outcome in ('ok', 'id differs', 'duplicate id') then case f when 5 then k + 1 when 9 then k - 9 else k end end as number,
  case when ok then p_name end as name, case when ok then (k % 4 + 1)::int end as players, case when ok then coalesce(made, planned, head) end as date,
  case when ok then case when made is not null then 'manufacture' when planned is not null then 'project' when head is not null then 'header' end end as date_source, case when ok then p_brand end as maker,
  case when ok then case when k % 2 = 0 then 'Design by: Ann Arc; Design by: Bo' else 'Design by: Cy Dee; Design by: Eve' end end as credits,
  case when ok then 'ROMs|rom ' || k || '|/f/' || k || '.zip|ZIP|' || p_size || ' KB|Ann; ROMs|sheet|/f/' || k || '.pdf|PDF||Bo' end as documents,
  case when ok and k % 3 = 1 then '/i/' || k || '.jpg 320x' || (k % 90 + 200) || ' Eve Front' end as images, case when ok and k % 6 = 0 then 'Cabinet Colour' end as unknown from d
""")
def model_pages(spark, sf):
    """What every machine page says, or why it says nothing."""
    pages, blobs = _machine_pages(spark, sf)
    found = tables.extract_models(pages, blobs, r"machine\.cgi\?id=(\d+)", "Cat No.", F.regexp_extract("url", r"machine\.cgi\?id=(\d+)", 1).try_cast("long"))
    listed = lambda c, f: F.when(F.size(c) > 0, F.array_join(F.transform(c, f), "; "))
    none = lambda c: F.coalesce(c, F.lit(""))
    return found.select(
        "page_id", "outcome", "number", "name", "players", "date", "date_source", F.try_element_at("fields", F.lit("Manufacturer")).alias("maker"),
        listed("credits", lambda x: F.concat_ws(": ", x["role"], x["name"])).alias("credits"),
        listed("documents", lambda x: F.concat_ws("|", x["section"], x["name"], x["url"], none(x["kind"]), none(x["size"]), none(x["credit"]))).alias("documents"),
        listed("images", lambda x: F.concat_ws(" ", x["url"], F.concat_ws("x", x["width"], x["height"]), x["credit"], x["description"])).alias("images"),
        F.array_join("unknown", "; ").alias("unknown"),
    )


@query("""
with p as (select p_partkey % 12 as f, p_partkey as k from part), o as (select case when f in (6, 10) then 'no blob' when f = 7 then 'unreadable' when f = 8 then 'not a model' when f = 5 then 'id differs' when f = 9 and k >= 9 and exists (select 1 from part q where q.p_partkey = p.k - 9) then 'duplicate id' else 'ok' end as outcome from p)
select outcome, count(*) as n from o group by outcome
""")
def model_outcomes(spark, sf):
    """How many pages came to which end, where the bytes of a twelfth are lost."""
    pages, blobs = _machine_pages(spark, sf)
    found = tables.extract_models(pages, blobs.where("page_id % 12 <> 6"), r"machine\.cgi\?id=(\d+)", "Cat No.", F.regexp_extract("url", r"machine\.cgi\?id=(\d+)", 1).try_cast("long"))
    return records.outcome_counts(found)


@query("""
with p as (select p_partkey as k, p_partkey % 3 as layout, regexp_extract(p_name, '^(\\S+)', 1) as a, regexp_extract(p_name, '(\\S+)$', 1) as b, p_brand, p_size from part)
select k as page_id, a as term, lower(a) as slug, case when layout = 1 then 't' || k end as anchor,
  'Round ' || p_size || ' thing. Also called ' || b || '.' || case when layout = 2 then '' else ' See ' || p_brand || '.' end as definition, b as aliases, case when layout <> 2 then p_brand end as see_also,
  case layout when 0 then null when 1 then 'noun' end as entity_type, case when layout = 2 then p_brand end as maker, case when layout = 2 then (1950 + k % 50)::int end as year, case when layout = 2 then b end as title from p
""")
def glossary_pages(spark, sf):
    """Terms of three page layouts with their aliases, references, kinds and games."""
    k, part = F.col("p_partkey"), table(spark, sf, "part")
    a, b = F.element_at(F.split("p_name", " "), 1), F.element_at(F.split("p_name", " "), -1)
    said = _join("Round ", F.col("p_size"), " thing. Also called ", b, ".")
    see = _join(" See ", F.col("p_brand"), ".")
    first = _join("<dl><dt>", a, "</dt><dd>", said, "</dd><dd>", see, "</dd></dl>")
    second = _join("<h2>Index</h2><h2 id=t", k, ">", a, " (noun)</h2><p>", said, see, "</p>")
    third = _join("<h3>", a, "</h3><p>", said, "</p><ul><li>", F.col("p_brand"), "'s ", k % 50 + 1950, " '", b, "'</ul>")
    pages = part.select(k.alias("page_id"), F.when(k % 3 == 0, first).when(k % 3 == 1, second).otherwise(third).alias("html"))
    tags = tables.tag_stream(pages)
    layouts = [
        (F.col("page_id") % 3 == 0, F.col("tag") == "dt", F.col("tag") == "dd"),
        (F.col("page_id") % 3 == 1, (F.col("tag") == "h2") & F.col("id").isNotNull(), F.col("tag") == "p"),
        (F.col("page_id") % 3 == 2, F.col("tag") == "h3", F.col("tag") == "p"),
    ]
    found = reduce(DataFrame.unionByName, (tables.glossary_terms(tags.where(own), term, definition) for own, term, definition in layouts))
    games = tags.where("tag = 'li'").groupBy("page_id").agg(F.min("text").alias("game"))
    rows = found.join(games, "page_id", "left").select("*", parse.term_parts(F.col("term")).alias("t"), parse.game_reference(F.col("game")).alias("g"))
    return rows.select(
        "page_id", F.col("t.term").alias("term"), parse.slug(F.col("t.term")).alias("slug"), "anchor", "definition", F.array_join(parse.aliases_of(F.col("definition")), ",").alias("aliases"),
        F.nullif(F.array_join(parse.see_also(F.col("definition")), ","), F.lit("")).alias("see_also"), F.col("t.entity_type").alias("entity_type"), F.col("g.maker").alias("maker"), F.col("g.year").alias("year"), F.col("g.title").alias("title"),
    )

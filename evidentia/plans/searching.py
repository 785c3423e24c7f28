"""Search queries: units of a term, postings, match counts, snippets and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.functions import text as tx
from evidentia.operators import library, search
from evidentia.plans import table
from evidentia.plans.corpus import _LINES, _TOKENS, _marked

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""
with w as (select item_id, string_split(regexp_replace(text, '[^A-Za-z ]', ' ', 'g'), ' ') as w from benchmark),
x as (select item_id, list_filter(w, lambda s: s <> '') as w from w),
t as (select item_id, lower(w[1] || ' ' || w[2]) as a, lower(w[3]) as b, lower(array_to_string(w[4:], ' ')) as c from x where len(w) > 3)
select item_id, unnest([a, b, c]) as unit from t
""")
def search_units(spark, sf):
    """Search terms made from the benchmark: a quoted phrase, a word, and a quoted run that never closes."""
    words = F.filter(F.split(F.regexp_replace("text", "[^A-Za-z ]", " "), " "), lambda s: s != "")
    rows = table(spark, sf, "benchmark").select("item_id", words.alias("w")).where("size(w) > 3")
    quote = F.lit('"')
    term = F.concat(quote, F.get("w", F.lit(0)), F.lit(" "), F.get("w", F.lit(1)), quote, F.lit("  "), F.get("w", F.lit(2)), F.lit(" "), quote, F.array_join(F.slice("w", F.lit(4), F.size("w")), " "))
    return rows.select("item_id", F.explode(tx.search_units(F.lower(term))).alias("unit"))


@query(rf"""with t as (select doc_id, regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+') as w from documents),
e as (select doc_id, unnest(w) as term, unnest(range(len(w))) as pos from t),
p as (select doc_id, term, pos, lead(term) over (partition by doc_id order by pos) as next from e)
select doc_id, count(*) as n from p where term = 'in' and next = 'the' group by doc_id""")
def postings_phrase(spark, sf):
    """A phrase looked up in the index of positions."""
    index = search.postings(table(spark, sf, "documents"), "doc_id", "text")
    return search.postings_phrase(index, ["in", "the"], "doc_id")


@query(rf"""with t as (select doc_id, regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+') as w from documents),
e as (select doc_id, unnest(w) as term, unnest(range(len(w))) as pos from t),
p as (select *, lead(term) over k as n1, lead(term, 2) over k as n2 from e window k as (partition by doc_id order by pos)),
s as (select doc_id, pos as a, pos + 2 as b from p where term = 'of' and n1 = 'the' union all select doc_id, pos, pos + 2 from p where term = 'the' and n1 = 'and' union all select doc_id, pos, pos + 1 from p where term = 'the'),
g as (select *, max(b) over (partition by doc_id order by a, b rows between unbounded preceding and 1 preceding) as reach from s)
select doc_id, count(*) filter (where reach is null or a >= reach) as regions from g group by doc_id""")
def match_counts(spark, sf):
    """Marked regions of two phrases and a loose word; what overlaps is one region."""
    return search.match_regions(table(spark, sf, "documents"), [["of", "the"], ["the", "and"], ["the"]], "doc_id", "text")


@query(rf"""with t as (select doc_id, regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+') as w from documents),
m as (select doc_id, w, list_transform(w, lambda x: case when x in ('license', 'under') then 1 else 0 end) as h from t),
k as (select doc_id, w, h, unnest(range(greatest(len(w) - 12, 0) + 1)) as i from m where list_contains(h, 1)),
b as (select * from k qualify row_number() over (partition by doc_id order by list_sum(h[i + 1:i + 12]) desc, i) = 1)
select doc_id, case when i > 0 then '… ' else '' end || array_to_string(list_transform(w[i + 1:i + 12], lambda x: case when x in ('license', 'under') then '[' || x || ']' else x end), ' ') || case when i + 12 < len(w) then ' …' else '' end as snippet from b""")
def snippets(spark, sf):
    """Twelve tokens around the densest matches."""
    return search.snippet(table(spark, sf, "documents"), ["license", "under"], "doc_id", "text")


_REGIONS = rf"""{_LINES},
r as (select doc_id, line_no, line, last_value(case when heading is not null then line_no end ignore nulls) over w as section_start, 1 + sum((line = chr(12) and line_no < last_line)::int) over w as page_no from l2 window w as (partition by doc_id order by line_no)),
v as (select *, {_TOKENS.replace("text", "line")} as folded from r),
x as (select doc_id, line_no, section_start, page_no, unnest(regexp_extract_all(folded, '[\p{{L}}\p{{N}}]+')) as term, unnest(range(len(regexp_extract_all(folded, '[\p{{L}}\p{{N}}]+')))) as p from v),
y as (select *, lead(term) over (partition by doc_id order by line_no, p) as next from x)"""


@query(f"with {_REGIONS} select doc_id, section_start, count(*) as matches from y where term = 'of' and next = 'the' group by all")
def matched_sections(spark, sf):
    """Sections that a phrase starts in, with counts; a match may run over a line's end."""
    return search.matched_regions(_marked(spark, sf).withColumn("section_start", F.col("section_start").cast("long")), ["of", "the"], "doc_id", ["section_start"])


@query(f"with {_REGIONS} select doc_id, page_no::bigint as page_no, count(*) as matches from y where term = 'of' and next = 'the' group by all")
def matched_pages(spark, sf):
    """The same by page."""
    return search.matched_regions(_marked(spark, sf), ["of", "the"], "doc_id", ["page_no"])


@query(rf"""with t as (select 'text' as tier, doc_id, regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+') as w from documents union all
  select 'ocr', conv_id, regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+') from (select conv_id, string_agg(text, ' ' order by turn) as text from conversations group by conv_id)),
c as (select tier, doc_id, len(list_filter(w, lambda x: x = 'license')) as n from t)
select coalesce(a.doc_id, b.doc_id) as doc_id, a.n as text_matches, b.n as ocr_matches from (select * from c where tier = 'text' and n > 0) a full join (select * from c where tier = 'ocr' and n > 0) b on a.doc_id = b.doc_id""")
def tier_counts(spark, sf):
    """Match counts of both tiers, each filled in where the document has the tier."""
    talk = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), " ").alias("text"))
    counts = lambda rows, name: search.phrase_hits(rows, [["license"]], "doc_id", "text").where("tf0 > 0").select("doc_id", F.col("tf0").cast("long").alias(name))
    return counts(table(spark, sf, "documents"), "text_matches").join(counts(talk, "ocr_matches"), "doc_id", "full_outer")


@query("""select doc_id, case when label is null then subject when contains(lower(label), lower(subject)) then label else subject || ' – ' || label end as title
from (select doc_id, source as subject, case when doc_id % 4 = 0 then null when doc_id % 4 = 1 then upper(source) || ' notes' else lang || ' notes' end as label from documents)""")
def display_titles(spark, sf):
    """The subject leads a title unless the title has it already."""
    label = F.when(F.col("doc_id") % 4 == 0, F.lit(None)).when(F.col("doc_id") % 4 == 1, F.concat(F.upper("source"), F.lit(" notes"))).otherwise(F.concat("lang", F.lit(" notes")))
    return table(spark, sf, "documents").select("doc_id", library.display_title(label, F.col("source"), F.lit("untitled")).alias("title"))

"""Line dedup over content-defined chunks of lines, in DataFrame functions only.

A chunk ends after a line where the rolling hash of that line and the one
before it is 0 modulo ``every`` (and at the end of the text), so an inserted
line moves no later boundary. A chunk with at least two lines that hold a
word, equal byte for byte to the chunk's first occurrence in the table, is
removed there. The first occurrence is the one with the smallest document id
(null last) and position.

What is shuffled to find repeats is a chunk's hash, length and place. The texts
that hold a first occurrence are joined once to fetch its bytes, and all texts once
to be compared with them and cut. Counting is a partial aggregate, and a chunk that
very many texts hold is a join that Spark may split. The two joins of the texts are
merge joins at every size, so that the plan of a small table is that of a large one.

Defined results: a null text stays null with 0 lines; an empty text is one
empty line; rows that repeat an id keep the chunks at equal positions; an
empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.own import Own
from dimloom.operators.ids import materialize

EVERY = 4
WORD = r"[^\x20\x09-\x0D]"
ADDED = ["n_lines", "n_chunks", "n_removed_lines"]


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunked(df: DataFrame, every: int) -> DataFrame:
    """``df`` (with ``body``) with ``lines`` and ``chunks``, an array of (k, first, size)."""
    d = df.withColumn("lines", F.split("body", "\n", -1))
    d = computed(d, "lines", F.col("lines"))
    d = computed(d, "hashes", F.transform("lines", line_hash))
    size, before = F.size("hashes"), lambda i: F.when(i > 0, 31 * F.col("hashes")[i - 1]).otherwise(0)
    d = computed(d, "ends", F.filter(F.transform("hashes", lambda h, i: F.when(((h + before(i)) % every == 0) | (i == size - 1), i + 1)),
                                     lambda e: e.isNotNull()))
    start = lambda k: F.when(k > 0, F.col("ends")[k - 1]).otherwise(0)
    d = computed(d, "chunks", F.transform("ends", lambda e, k: F.struct(k.alias("k"), start(k).alias("first"), (e - start(k)).alias("size"))))
    return d.drop("hashes", "ends")


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``name`` evaluated once a row: a generator of one element, which later lambdas refer to and never inline."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def chunk_text(chunk: Column) -> Column:
    return F.array_join(F.slice("lines", chunk["first"] + 1, chunk["size"]), "\n")


def pieces(df: DataFrame, every: int) -> DataFrame:
    """(id, print, k, key, chars, piece) of the chunks of (id, print, body) that have two lines with a word, or more."""
    return (chunked(df.select("id", "print", "body"), every)
            .select("id", "print", F.explode("chunks").alias("chunk"), "lines")
            .where("chunk.size >= 2")
            .select("id", "print", "chunk.k", chunk_text(F.col("chunk")).alias("piece"))
            .where(F.size(F.filter(F.split("piece", "\n", -1), lambda line: line.rlike(WORD))) >= 2)
            .select("id", "print", "k", F.xxhash64("piece").alias("key"), F.length("piece").alias("chars"), "piece"))


def offers(df: DataFrame, every: int) -> DataFrame:
    """(id, print, offered): for each text of (id, print, body) the places k of chunks that look repeated, with the bytes of their first occurrence."""
    found = materialize(pieces(df, every).drop("piece"), "line-chunks")  # hashes and places, no text
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "k", "print")
    # written first, so that Spark sees its size and may split the joins on a common chunk
    first = materialize(found.groupBy("key", "chars").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                        .where("n > 1").select("key", "chars", F.col("first.id").alias("id"), F.col("first.print").alias("print"), F.col("first.k").alias("k")), "line-firsts")
    wanted = first.groupBy("id", "print").agg(F.collect_set("k").alias("wanted")).withColumnsRenamed({"id": "first_id", "print": "first_print"})
    holders = df.join(wanted.hint("merge"), df["id"].eqNullSafe(wanted["first_id"]) & (df["print"] == wanted["first_print"]))
    kept = chunked(holders.select("body", "wanted"), every).select("lines", F.explode(F.filter("chunks", lambda c: F.array_contains("wanted", c["k"]))).alias("chunk"))
    kept = kept.select(chunk_text(F.col("chunk")).alias("piece")).select(F.xxhash64("piece").alias("key"), F.length("piece").alias("chars"), "piece")
    kept = materialize(kept.groupBy("key", "chars").agg(F.min("piece").alias("piece")), "line-kept")
    later = found.join(first.withColumnsRenamed({"id": "first_id", "print": "first_print", "k": "first_k"}), ["key", "chars"]).where(
        ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("k") == F.col("first_k"))))
    return (materialize(later.select("id", "print", "k", "key", "chars"), "line-later").join(kept, ["key", "chars"])
            .groupBy("id", "print").agg(F.collect_list(F.struct("k", "piece")).alias("offered")))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY) -> DataFrame:
    """``docs`` with repeated chunks cut from ``text``, and the columns ``ADDED``."""
    own = Own(docs)
    d = own.df.withColumns({"id": own[doc_id], "body": own[text], "print": F.xxhash64(own[text])})
    offered = offers(d, every).select(F.col("id").alias("gone_id"), F.col("print").alias("gone_print"), "offered")
    # the text crosses the join once; its lines are cut again behind it, and compared byte for byte
    d = d.drop("body").join(offered.hint("merge"), d["id"].eqNullSafe(offered["gone_id"]) & (d["print"] == offered["gone_print"]), "left")
    d = chunked(d.withColumn("body", own[text]), every)
    same = F.filter("offered", lambda o: chunk_text(F.col("chunks")[o["k"]]) == o["piece"])
    d = computed(d, "gone", F.when(F.size(same) > 0, F.transform(same, lambda o: o["k"])))
    left = F.filter("chunks", lambda c: F.col("gone").isNull() | ~F.array_contains("gone", c["k"]))
    removed = F.filter("chunks", lambda c: F.col("gone").isNotNull() & F.array_contains("gone", c["k"]))
    new_text = F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(F.transform(left, chunk_text), "\n"))
    zero = F.lit(0).cast("long")
    return d.select(*own.back(ADDED, {text: new_text}),
                    F.when(F.col("lines").isNull(), zero).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                    F.when(F.col("lines").isNull(), zero).otherwise(F.size("chunks")).cast("long").alias("n_chunks"),
                    F.when(F.col("gone").isNull(), zero).otherwise(F.aggregate(removed, zero, lambda s, c: s + c["size"])).alias("n_removed_lines"))


ORACLE = rf"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
  from documents),
hashed as (select *, ('0x' || substr(md5(line), 1, 8))::BIGINT as h from lines),
rolled as (select *, h + 31 * coalesce(lag(h) over (partition by doc_id order by i), 0) as r from hashed),
cut as (select *, coalesce(sum(case when r % {EVERY} = 0 then 1 else 0 end)
          over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as k from rolled),
chunks as (
  select doc_id, k, string_agg(line, chr(10) order by i) as body, count(*) as size,
         count(*) filter (where regexp_matches(line, '[^ \x09-\x0D]')) as n_full
  from cut group by doc_id, k),
judged as (
  select *, size >= 2 and n_full >= 2
            and row_number() over (partition by body, size >= 2 and n_full >= 2 order by doc_id, k) > 1 as gone
  from chunks)
select d.doc_id,
       case when d.text is null then null else coalesce(string_agg(j.body, chr(10) order by j.k) filter (where not j.gone), '') end as text,
       coalesce(sum(j.size), 0)::BIGINT as n_lines, count(j.k) as n_chunks,
       coalesce(sum(j.size) filter (where j.gone), 0)::BIGINT as n_removed_lines
from documents d left join judged j using (doc_id) group by d.doc_id, d.text
"""

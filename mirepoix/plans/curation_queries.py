"""Queries: instruction pairs, ordering, splitting, rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from mirepoix import lookups
from mirepoix.functions.core import split_words
from mirepoix.operators import chats, curation
from mirepoix.plans.registry import query
from mirepoix.plans.views import clean, documents, pairs, table, with_views
from mirepoix.session import store


def stored_pairs(spark, sf_dir):
    """The pairs, computed once: ordering and splitting read their keys several times."""
    return store(pairs(spark, sf_dir), "pairs")


@query("instruction_pairs", with_views("pairs", "SELECT id, instruction, output FROM pairs"))
def instruction_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


@query("filter_length", """
SELECT doc_id, CAST(length(text) AS INT) AS n FROM documents WHERE length(text) > 200""")
def filter_length(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return curation.filter_length(docs, 200, "text").select("doc_id", F.length("text").alias("n"))


@query("seeded_shuffle", with_views("pairs", """
SELECT id, instruction, md5('42:' || id) AS sort_key FROM pairs"""))
def seeded_shuffle(spark, sf_dir):
    return curation.seeded_shuffle(stored_pairs(spark, sf_dir)).select(
        "id", "instruction", curation.seeded_key(42, "id").alias("sort_key"))


@query("seeded_subset", with_views("pairs", """
SELECT id, instruction FROM pairs ORDER BY md5('42:' || id) LIMIT 500"""))
def seeded_subset(spark, sf_dir):
    return curation.seeded_subset(stored_pairs(spark, sf_dir), 500).select("id", "instruction")


_SPLIT = """
SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || id)) <= ceil(count(*) OVER () * 0.05::DOUBLE)
               THEN 'test' ELSE 'train' END AS split FROM pairs"""


@query("train_test_split", with_views("pairs", f"SELECT id, split FROM ({_SPLIT}) AS s"))
def train_test_split(spark, sf_dir):
    return curation.train_test_split(stored_pairs(spark, sf_dir)).select("id", "split")


@query("train_test_split_documents", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id)) <= ceil(count(*) OVER () * 0.05::DOUBLE)
                    THEN 'test' ELSE 'train' END AS split FROM documents""")
def train_test_split_documents(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id")
    return curation.train_test_split(docs, key="doc_id")


@query("golden_sample", with_views("pairs", f"""
SELECT id, instruction, output FROM ({_SPLIT}) AS s WHERE split = 'test'
ORDER BY md5('43:' || id), id LIMIT 5"""))
def golden_sample(spark, sf_dir):
    split = curation.train_test_split(stored_pairs(spark, sf_dir))
    return curation.golden_sample(split).drop("split")


_INFER = "concat('Instruction: ', instruction, chr(10), chr(10), 'Recipe:')"


@query("render_prompt", with_views("pairs", f"""
SELECT pairs.id, concat({_INFER}, ' ', output, '{lookups.END_OF_TEXT}') AS qlora,
       concat({_INFER}, ' ', output) AS prompt_tuning,
       concat(instruction, chr(10), chr(10), output) AS ia3, {_INFER} AS inference,
       concat('{lookups.PERSONA_OPENING}', chr(10), chr(10), 'Dish: ', instruction, chr(10),
              chr(10), '{lookups.PERSONA_MARKER}') AS chef,
       concat('Create a detailed recipe for ', name, ' using these ingredients: ',
              ingredients_text, '.') AS with_ingredients
FROM pairs JOIN clean ON pairs.id = clean.id"""))
def render_prompt(spark, sf_dir):
    rows = clean(spark, sf_dir).select(
        "id", "name", "ingredients_text", "steps_string_standardize")
    built = rows.select(
        "id", "name", "ingredients_text",
        F.concat(F.lit("Create a detailed recipe for "), "name", F.lit(".")).alias("instruction"),
        F.concat(F.lit("Ingredients:\n"), "ingredients_text", F.lit("\n\nInstructions:\n"),
                 "steps_string_standardize").alias("output"),
    )
    styles = ("qlora", "prompt_tuning", "ia3", "inference", "chef", "with_ingredients")
    for style in styles:
        built = curation.render_prompt(built, style, style)
    return built.select("id", *styles)


_CHAT_LINE = "concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10))"


@query("render_chat", f"""
SELECT conv_id, concat(
         CASE WHEN arg_min(role, turn) = 'system' THEN '' ELSE
           concat('<|im_start|>system', chr(10), '{lookups.DEFAULT_SYSTEM_MESSAGE}', '<|im_end|>', chr(10)) END,
         string_agg({_CHAT_LINE}, '' ORDER BY turn), '<|im_start|>assistant', chr(10)) AS text
FROM conversations GROUP BY conv_id""")
def render_chat(spark, sf_dir):
    return chats.render_chat(table(spark, sf_dir, "conversations"), generation_prompt=True)


@query("render_chat_parts", f"""
SELECT conv_id, turn, concat(
         CASE WHEN place > 1 OR role = 'system' THEN '' ELSE
           concat('<|im_start|>system', chr(10), '{lookups.DEFAULT_SYSTEM_MESSAGE}', '<|im_end|>', chr(10)) END,
         {_CHAT_LINE}) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations) AS c""")
def render_chat_parts(spark, sf_dir):
    """One row per message."""
    return chats.render_chat_messages(table(spark, sf_dir, "conversations"))


@query("render_flat_chat", """
SELECT conv_id, concat(string_agg(concat(role, ': ', text, chr(10)), '' ORDER BY turn),
       'assistant:') AS text FROM conversations GROUP BY conv_id""")
def render_flat_chat(spark, sf_dir):
    return chats.render_flat_chat(table(spark, sf_dir, "conversations"))


_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"


@query("sequence_budget", f"""
SELECT doc_id, CAST(n AS INT) AS n_tokens, n > 512 AS over_budget, 512 AS n_labels,
       CAST(greatest(512 - n, 0) AS INT) AS n_padding,
       array_to_string(list_slice(w, 1, 512), ' ') || repeat(' <pad>', greatest(512 - n, 0)::BIGINT) AS tokens
FROM (SELECT doc_id, {_WORDS} AS w, len({_WORDS}) AS n FROM documents) AS t""")
def sequence_budget(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return curation.sequence_budget(docs).select(
        "doc_id", "n_tokens", "over_budget", F.size("labels").alias("n_labels"),
        F.size(F.filter("attention", lambda a: a == 0)).alias("n_padding"),
        F.array_join("tokens", " ").alias("tokens"),
    )


@query("length_buckets", f"""
SELECT CAST(floor(len({_WORDS}) / 64) AS BIGINT) AS bucket, count(*) AS n_texts FROM documents GROUP BY 1""")
def length_buckets(spark, sf_dir):
    return curation.length_buckets(documents(spark, sf_dir).select("text"))


@query("group_by_length", f"""
SELECT doc_id, CAST(len({_WORDS}) AS INT) AS n_tokens FROM documents""")
def group_by_length(spark, sf_dir):
    docs = curation.group_by_length(documents(spark, sf_dir))
    return docs.select("doc_id", F.size(split_words(F.col("text"))).alias("n_tokens"))


_BATCHES = f"""
sized AS (SELECT doc_id, CAST(coalesce(len({_WORDS}), 0) AS INT) AS n_tokens,
                 row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) - 1 AS place FROM documents),
mega AS (SELECT *, size, place // size AS mega, row_number() OVER (PARTITION BY place // size ORDER BY n_tokens DESC, place) - 1 AS nth
         FROM sized, (SELECT greatest(1, least(50, count(*) // 32)) * 8 AS size FROM documents)),
top AS (SELECT mega AS top FROM mega WHERE nth = 0 ORDER BY n_tokens DESC, mega LIMIT 1),
batches AS (SELECT doc_id, n_tokens,
  ((CASE WHEN nth = 0 AND mega = 0 THEN top WHEN nth = 0 AND mega = top THEN 0 ELSE mega END) * size + nth) // 8 AS batch,
  CAST(nth % 8 AS INT) AS slot FROM mega, top)"""


@query("length_grouped_batches", f"WITH {_BATCHES} SELECT doc_id, n_tokens, batch, slot FROM batches")
def length_grouped_batches(spark, sf_dir):
    docs = curation.length_grouped_batches(documents(spark, sf_dir), 8, 7, "doc_id")
    return docs.select("doc_id", "n_tokens", "batch", "slot")


@query("padding_waste", f"""
WITH {_BATCHES}, each AS (SELECT batch, count(*) AS n, sum(n_tokens) AS tokens, max(n_tokens) AS longest FROM batches GROUP BY batch)
SELECT CAST(sum(n) AS BIGINT) AS n_texts, count(*) AS n_batches, CAST(sum(tokens) AS BIGINT) AS n_tokens,
       CAST(sum(n * longest - tokens) AS BIGINT) AS n_padding FROM each""")
def padding_waste(spark, sf_dir):
    return curation.padding_waste(curation.length_grouped_batches(documents(spark, sf_dir), 8, 7, "doc_id"))

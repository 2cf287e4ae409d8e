"""Genomic views derived from the supplied relational tables, so that every operator runs on them. The SQL twins are in oracles.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read a line item, positions dense enough for deep buckets; cigars of three shapes."""
    li = table(spark, sf_dir, "lineitem")
    e = F.expr
    return li.select(
        e("concat(l_orderkey, ':', l_linenumber, ':', l_partkey)").alias("id"),
        e("concat('frag', l_orderkey)").alias("fragment_name"),
        e("CASE WHEN l_orderkey % 101 = 0 THEN '*' WHEN l_suppkey % 25 = 0 THEN 'GL.1' WHEN l_suppkey % 25 = 23 THEN 'chrX' WHEN l_suppkey % 25 = 24 THEN 'chrY' ELSE concat('chr', l_suppkey % 25) END").alias("reference_name"),
        e("l_partkey * 8 + l_linenumber").alias("position"),
        e("CAST(round(l_discount * 500) AS INT)").alias("mapping_quality"),
        e("concat(l_returnflag, l_linestatus)").alias("read_group_set_id"),
        e("l_linenumber % 2 = 0").alias("reverse_strand"),
        e("l_linenumber = 7").alias("duplicate_fragment"),
        e("l_tax >= 0.08").alias("failed_vendor_quality_checks"),
        e("l_quantity > 2").alias("proper_placement"),
        e("""CASE l_linenumber % 3
            WHEN 0 THEN array(named_struct('operation', 'ALIGNMENT_MATCH', 'operation_length', CAST(l_quantity AS BIGINT)))
            WHEN 1 THEN array(named_struct('operation', 'CLIP_SOFT', 'operation_length', 2L), named_struct('operation', 'ALIGNMENT_MATCH', 'operation_length', CAST(l_quantity AS BIGINT)))
            ELSE array(named_struct('operation', 'ALIGNMENT_MATCH', 'operation_length', CAST(l_quantity AS BIGINT) div 2), named_struct('operation', 'DELETE', 'operation_length', 3L),
                named_struct('operation', 'ALIGNMENT_MATCH', 'operation_length', CAST(l_quantity AS BIGINT) - CAST(l_quantity AS BIGINT) div 2)) END""").alias("cigar"),
        e("substring(repeat('ACGT', 16), CAST((l_partkey + l_linenumber) % 4 + 1 AS INT), CAST(l_quantity AS INT) + CASE WHEN l_linenumber % 3 = 1 THEN 2 ELSE 0 END)").alias("aligned_sequence"),
        e("transform(sequence(1, CAST(l_quantity AS INT) + CASE WHEN l_linenumber % 3 = 1 THEN 2 ELSE 0 END), i -> CAST(10 + l_linenumber AS BIGINT))").alias("aligned_quality"),
        e("CASE WHEN l_suppkey % 3 = 0 THEN 'chr1' END").alias("mate_reference_name"),
        e("CASE WHEN l_suppkey % 3 = 0 THEN l_suppkey * 8 END").alias("mate_position"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants without calls, from part."""
    e = F.expr
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey"),
        e("concat('v', p_partkey)").alias("id"), e("concat('chr', p_partkey % 22 + 1)").alias("reference_name"), e("p_partkey * 8 + 3").alias("start"),
        e("p_partkey * 8 + 3 + CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 1 END").alias("end"),
        e("concat(substring('ACGT', p_size % 4 + 1, 1), CASE WHEN p_partkey % 7 = 0 THEN 'A' ELSE '' END)").alias("reference_bases"),
        e("CASE WHEN p_partkey % 11 = 0 THEN array(substring('ACGT', (p_size + 1) % 4 + 1, 1), substring('ACGT', (p_size + 2) % 4 + 1, 1)) ELSE array(substring('ACGT', (p_size + 1) % 4 + 1, 1)) END").alias("alternate_bases"),
        e("CASE WHEN p_partkey % 13 = 0 THEN 0.0D ELSE p_retailprice END").alias("quality"),
        e("CASE p_partkey % 9 WHEN 0 THEN array('q10') WHEN 1 THEN array('PASS', 'q10') WHEN 2 THEN array('.') ELSE array('PASS') END").alias("filter"),
        e("map('AF', array(CAST((p_size % 50 + 0.5D) / 51 AS STRING)))").alias("info"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, calls): a call a nation whose customers bought the part."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
    # nation is a fixed table of 25 rows
    o = o.join(F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")), F.expr("c_nationkey = n_nationkey")).select("o_orderkey", "n_name")
    by = li.join(o, F.expr("l_orderkey = o_orderkey")).groupBy("l_partkey", "n_name").agg(F.min("l_linenumber").alias("a"), F.max(F.col("l_quantity").cast("int")).alias("b"))
    call = F.struct(F.col("n_name").alias("call_set_name"), F.array((F.col("a") % 3 - 1).cast("int"), (F.col("b") % 2).cast("int")).alias("genotype"))
    return by.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array_sort(F.collect_list(call)).alias("calls"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.expr("CAST(array() AS array<struct<call_set_name: string, genotype: array<int>>>)")
    joined = sites(spark, sf_dir).join(calls(spark, sf_dir), "p_partkey", "left")
    return joined.withColumn("calls", F.coalesce("calls", empty)).drop("p_partkey")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-variant segments from orders, with one call each; the columns of variants."""
    e = F.expr
    return table(spark, sf_dir, "orders").select(
        e("concat('b', o_orderkey)").alias("id"), e("concat('chr', o_custkey % 22 + 1)").alias("reference_name"), e("o_custkey * 10").alias("start"),
        e("o_custkey * 10 + 50 + o_orderkey % 2000").alias("end"), e("'A'").alias("reference_bases"), e("CAST(array() AS array<string>)").alias("alternate_bases"),
        e("1.0D").alias("quality"), e("array('PASS')").alias("filter"), e("map('AF', array('0.5'))").alias("info"),
        e("array(named_struct('call_set_name', concat('B', o_orderkey), 'genotype', array(0, CAST(o_orderkey % 2 AS INT) - 1)))").alias("calls"),
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transcript of two exons for each supplier, laid over the variants of one chromosome."""
    e = F.expr
    return table(spark, sf_dir, "supplier").select(
        e("concat('t', s_suppkey)").alias("id"), e("concat('chr', s_suppkey % 22 + 1)").alias("reference_name"), e("s_suppkey * 160").alias("start"), e("s_suppkey * 160 + 1800").alias("end"),
        e("s_suppkey % 2 = 1").alias("reverse_strand"), e("substring(repeat('ACTTGGGTCAC', 180), CAST(s_suppkey % 11 + 1 AS INT), 1800)").alias("bases"),
        e("""named_struct('gene_id', concat('g', s_suppkey % 40),
            'coding_sequence', CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE named_struct('start', s_suppkey * 160 + 30, 'end', s_suppkey * 160 + 1700) END,
            'exons', array(named_struct('start', s_suppkey * 160 + 10, 'end', s_suppkey * 160 + 800, 'frame', CAST(s_suppkey % 3 AS INT)),
                           named_struct('start', s_suppkey * 160 + 900, 'end', s_suppkey * 160 + 1750, 'frame', CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE CAST((s_suppkey + 1) % 3 AS INT) END)))""").alias("transcript"),
    )


def known_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known annotations of every third part's first alternate base; a null start stands for 0."""
    e = F.expr
    s = sites(spark, sf_dir).where("p_partkey % 3 = 0")
    return s.select(
        e("concat('a', p_partkey)").alias("id"), e("replace(reference_name, 'chr', '')").alias("reference_name"), "start", "end",
        e("named_struct('alternate_bases', alternate_bases[0], 'type', 'SNP', 'effect', 'KNOWN', 'gene_id', concat('k', p_partkey % 17), 'transcript_ids', CAST(array() AS array<string>))").alias("variant"),
    )


def site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines with changing delimiters, headers and junk."""
    return table(spark, sf_dir, "part").select(F.expr("""CASE p_partkey % 6 WHEN 0 THEN concat('chr', p_partkey % 22 + 1, ',', p_partkey * 8, ',', p_partkey * 8 + 200)
        WHEN 1 THEN concat('  chr', p_partkey % 22 + 1, '  ', p_partkey * 8, '    ', p_partkey * 8 + 100, ' ') WHEN 2 THEN concat('GL.', p_partkey, ':', p_partkey * 8, ':', p_partkey * 8 + 50)
        WHEN 3 THEN concat('X,', p_partkey, ',', p_partkey + 9, ',foo,bar') WHEN 4 THEN concat('track name=', p_brand) ELSE '' END""").alias("value"))

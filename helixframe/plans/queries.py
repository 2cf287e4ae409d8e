"""The registered queries: each applies an operator to the whole derived views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reads as R
from ..functions import regions, variants as V
from ..operators import annotate, contamination, coverage, rangejoin, similarity
from ..operators import variants as ops
from ..streaming import buckets
from . import views

WIDTH, QUANTILES, LOCI, BIN = 64, 3, 10_000, 1000
REGION = ("chr5", 1000, 9000)
FRIENDS = [f"NATION_{i}" for i in range(22)]
ALPHAS = (0.05, 0.2)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def six(x: Column) -> Column:
    """Rounded half up to six places."""
    return F.floor(x * 1e6 + 0.5) / 1e6


@query
def count_reads(spark, d):
    return coverage.count_reads(views.reads(spark, d), ~R.is_unmapped(F.col("reference_name")))


@query
def count_reads_region(spark, d):
    r = views.reads(spark, d)
    end = F.col("position") + R.covered_length(F.col("cigar"))
    strict, over = regions.starts_in(F.col("reference_name"), F.col("position"), REGION), regions.overlaps(F.col("reference_name"), F.col("position"), end, REGION)
    return r.where(F.col("reference_name") == REGION[0]).agg(F.count_if(strict).alias("strict"), F.count_if(over).alias("overlapping"))


@query
def count_by_read_group_set(spark, d):
    unmapped = R.is_unmapped(F.col("reference_name"))
    return views.reads(spark, d).groupBy("read_group_set_id").agg(F.count("*").alias("n_reads"), F.count_if(unmapped).alias("n_unmapped"))


@query
def coverage_means(spark, d):
    return coverage.coverage_means(views.reads(spark, d), WIDTH)


@query
def coverage_quantiles(spark, d):
    q = coverage.coverage_quantiles(coverage.coverage_means(views.reads(spark, d), WIDTH), QUANTILES)
    return q.select("reference_name", "bucket", "mq", *[F.col("quantiles")[i].alias(f"q{i}") for i in range(QUANTILES)])


@query
def coverage_annotations(spark, d):
    a = coverage.coverage_annotations(coverage.coverage_quantiles(coverage.coverage_means(views.reads(spark, d), WIDTH), QUANTILES), WIDTH)
    return a.select("reference_name", "start", "end", F.size("info").cast("long").alias("n_classes"), F.element_at("info", "A")[QUANTILES - 1].alias("most"))


@query
def read_filters(spark, d):
    c = F.col
    return views.reads(spark, d).agg(
        F.count_if(V.is_on_chromosome(c("reference_name"))).alias("on_chromosome"), F.count_if(~c("failed_vendor_quality_checks")).alias("not_failed"),
        F.count_if(~c("duplicate_fragment")).alias("not_duplicate"), F.count_if(c("proper_placement")).alias("proper"), F.count_if(R.is_unmapped(c("reference_name"))).alias("unmapped"),
        F.count_if(R.mapping_class(c("mapping_quality")) == "L").alias("low"), F.count_if(R.mapping_class(c("mapping_quality")) == "M").alias("middle"), F.sum(R.covered_length(c("cigar"))).alias("covered"),
    )


@query
def read_shards(spark, d):
    name, at = R.loci_shard(F.col("reference_name"), F.col("position"), F.col("mate_reference_name"), F.col("mate_position"), LOCI)
    return views.reads(spark, d).groupBy(name.alias("shard_reference"), at.alias("shard_start")).agg(F.count("*").alias("n_reads"))


@query
def reads_table(spark, d):
    """The nested warehouse rows, flattened for comparison."""
    from ..sources.warehouse import to_rows

    rows = to_rows(views.reads(spark, d))
    codes = F.array_join(F.transform("alignment.cigar", lambda c: F.concat(c.operation.cast("string"), F.lit("x"), c.operation_length.cast("string"))), ",")
    return rows.select("id", "fragment_name", "read_group_set_id", F.col("alignment.position.reference_name").alias("reference_name"), F.col("alignment.position.position").alias("position"), F.col("alignment.mapping_quality").alias("mapping_quality"), codes.alias("cigar"), F.size("aligned_quality").cast("long").alias("n_qualities"))


@query
def cigar_walk(spark, d):
    b = contamination.aligned_bases(contamination.usable_reads(views.reads(spark, d)))
    return b.groupBy("reference_name", "base").agg(F.count("*").alias("n"), F.sum("position").alias("positions"), F.sum("quality").alias("qualities"))


@query
def sites_parse(spark, d):
    return regions.parse_sites(views.site_lines(spark, d))


@query
def variant_filters(spark, d):
    c = F.col
    return views.sites(spark, d).select(
        "id", V.is_passing(c("filter")).alias("passing"), V.is_on_chromosome(c("reference_name")).alias("on_chromosome"), V.is_not_low_quality(c("quality")).alias("not_low_quality"),
        V.is_snp(c("reference_bases"), c("alternate_bases")).alias("snp"), V.is_single_alternate_snp(c("reference_bases"), c("alternate_bases")).alias("single_snp"),
    )


@query
def private_variants(spark, d):
    return ops.private_variants(views.variants(spark, d), FRIENDS).select("id", "reference_name", "start", "end", "reference_bases", F.array_join("alternate_bases", ",").alias("alternates"))


@query
def delete_variants(spark, d):
    lines = views.table(spark, d, "part").where("p_size % 5 = 0").select(F.concat(F.lit(" v"), F.col("p_partkey").cast("string"), F.lit(",chr1 7")).alias("value"))
    left, _ = ops.delete_variants(views.sites(spark, d), ops.listed_ids(lines))
    return left.select("id", "reference_name", "start")


@query
def deleted_count(spark, d):
    lines = views.table(spark, d, "part").where("p_size % 5 = 0").select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("value"))
    return ops.delete_variants(views.sites(spark, d), ops.listed_ids(lines))[1]


@query
def ibs_minor(spark, d):
    i = similarity.identity_by_state(views.variants(spark, d), "shared_minor")
    return i.select("s1", "s2", six(F.col("score")).alias("score"), "total", "n")


@query
def ibs_ratio(spark, d):
    i = similarity.identity_by_state(views.variants(spark, d), "shared_ratio")
    return i.select("s1", "s2", six(F.col("score")).alias("score"), "total", "n")


@query
def shared_variant_pairs(spark, d):
    return similarity.shared_variants(views.variants(spark, d))


@query
def pcoa(spark, d):
    return similarity.pcoa(similarity.shared_variants(views.variants(spark, d)))


@query
def gvcf_merge(spark, d):
    merged = rangejoin.merge_segments(views.variants(spark, d).unionByName(views.segments(spark, d)), BIN)
    names = F.array_join(F.transform("calls", lambda c: c.call_set_name), ",")
    return merged.select("id", "reference_name", "start", F.size("calls").cast("long").alias("n_calls"), F.md5(names.cast("binary")).alias("calls_md5"))


@query
def gvcf_merge_sites(spark, d):
    sites = regions.parse_sites(views.site_lines(spark, d))
    merged = rangejoin.merge_segments(views.variants(spark, d).unionByName(views.segments(spark, d)), BIN, sites)
    return merged.select("id", "reference_name", "start", F.size("calls").cast("long").alias("n_calls"))


@query
def allele_frequencies(spark, d):
    f = contamination.allele_frequencies(views.sites(spark, d))
    return f.select("reference_name", "position", "ref_base", "alt_base", six(F.col("ref_freq")).alias("ref_freq"))


@query
def sampled_positions(spark, d):
    b = contamination.sampled(contamination.aligned_bases(contamination.usable_reads(views.reads(spark, d))), 0.25)
    return b.groupBy("reference_name").agg(F.count("*").alias("n"), F.countDistinct("position").alias("n_positions"))


def _piles(spark, d, fraction=1.0):
    freq = contamination.allele_frequencies(views.sites(spark, d))
    bases = contamination.bases_at(freq, contamination.usable_reads(views.reads(spark, d)))
    return contamination.pileup(freq, contamination.sampled(bases, fraction))


@query
def pileup(spark, d):
    return _piles(spark, d).select("reference_name", "position", "base", "quality", "n")


@query
def contamination_log_likelihood(spark, d):
    return contamination.log_likelihood(_piles(spark, d), *ALPHAS).select("alpha", F.round("log_likelihood", 4).alias("log_likelihood"))


@query
def contamination_estimate(spark, d):
    return contamination.estimate(_piles(spark, d, 0.25))


@query
def annotate_exact(spark, d):
    e = annotate.exact_matches(views.sites(spark, d), views.known_annotations(spark, d))
    return e.select("reference_name", "start", "allele", "variant_id", F.col("variant.gene_id").alias("gene_id"))


@query
def annotate_effect(spark, d):
    e = annotate.transcript_effects(views.sites(spark, d), views.transcripts(spark, d))
    return e.select("reference_name", "start", "allele", "variant_id", F.col("variant.effect").alias("effect"), F.col("variant.gene_id").alias("gene_id"), F.col("variant.transcript_ids")[0].alias("transcript_id"))


@query
def annotate_variants(spark, d):
    a = annotate.annotate(views.sites(spark, d), views.known_annotations(spark, d), views.transcripts(spark, d))
    effects = F.array_join(F.array_sort(F.transform("annotations", lambda x: F.concat(x.effect, F.lit(":"), x.gene_id))), ",")
    return a.select("key", F.size("annotations").cast("long").alias("n"), effects.alias("effects"))


@query
def bam_diff(spark, d):
    from ..operators.diff import diff_reads

    a = views.reads(spark, d)
    b = a.where("NOT duplicate_fragment").withColumn("mapping_quality", F.when(F.col("position") % 50 == 0, F.col("mapping_quality") + 1).otherwise(F.col("mapping_quality")))
    return diff_reads(a, b, ["reference_name", "position", "id"], ["mapping_quality", "aligned_sequence"]).groupBy("status").agg(F.count("*").alias("n"))


@query
def event_buckets(spark, d):
    return buckets.event_buckets(views.table(spark, d, "events"))


@query
def bam_round_trip(spark, d):
    """All reads, written as a sorted BAM file with its index in the shared checkpoint folder and read back in shards of 64 KB."""
    from ..schemas import CIGAR_OPERATIONS
    from ..sources import bam

    letters = F.create_map(*[F.lit(x) for name, letter, _ in CIGAR_OPERATIONS for x in (name, letter)])
    placed, e = F.col("reference_name") != "*", F.expr
    flag = e("2 * int(proper_placement) + 16 * int(reverse_strand) + 512 * int(failed_vendor_quality_checks) + 1024 * int(duplicate_fragment)") + F.when(placed, 0).otherwise(4)
    rows = views.reads(spark, d).select(
        F.col("id").alias("qname"), flag.cast("int").alias("flag"), F.col("reference_name").alias("rname"), F.when(placed, F.col("position") + 1).otherwise(0).cast("long").alias("pos"),
        F.when(placed, F.col("mapping_quality")).otherwise(0).cast("int").alias("mapq"),
        F.when(placed, F.array_join(F.transform("cigar", lambda c: F.concat(c.operation_length.cast("string"), letters[c.operation])), "")).otherwise("*").alias("cigar"),
        F.coalesce("mate_reference_name", F.lit("*")).alias("rnext"), F.coalesce(F.col("mate_position") + 1, F.lit(0)).cast("long").alias("pnext"), F.lit(0).cast("long").alias("tlen"),
        F.col("aligned_sequence").alias("seq"), e("array_join(transform(aligned_quality, q -> char(q + 33)), '')").alias("qual"), e("array(concat('RG:Z:', read_group_set_id))").alias("tags"),
    )
    names = ["GL.1", *(f"chr{i}" for i in range(1, 23)), "chrX", "chrY"]
    path = f"{bam.shared_folder(spark)}/reads.bam"
    bam.write_bam(rows, {"SQ": [{"SN": n, "LN": str(1 << 29)} for n in names]}, path)
    back = bam.read_bam(spark, path, maxShardBytes=str(1 << 16))
    mate = F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext"))
    return back.select(F.col("qname").alias("id"), F.col("flag").cast("long").alias("flag"), F.col("rname").alias("reference_name"), F.col("pos").cast("long").alias("pos"), F.col("mapq").cast("long").alias("mapping_quality"), "cigar", mate.alias("mate_reference_name"), F.col("pnext").cast("long").alias("mate_pos"), "seq", "qual", F.array_join("tags", ",").alias("tags"))

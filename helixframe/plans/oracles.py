"""SQL (DuckDB) of the registered queries, on the same tables. WITH blocks mirror the views of views.py."""

from __future__ import annotations

from .queries import ALPHAS, FRIENDS, LOCI, QUANTILES, REGION, WIDTH

READS = """reads AS (SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey AS id, 'frag' || l_orderkey AS fragment_name,
  CASE WHEN l_orderkey % 101 = 0 THEN '*' WHEN l_suppkey % 25 = 0 THEN 'GL.1' WHEN l_suppkey % 25 = 23 THEN 'chrX' WHEN l_suppkey % 25 = 24 THEN 'chrY' ELSE 'chr' || (l_suppkey % 25) END AS reference_name,
  l_partkey * 8 + l_linenumber AS position, CAST(round(l_discount * 500) AS BIGINT) AS mq, l_returnflag || l_linestatus AS rgs, l_linenumber, l_suppkey,
  l_linenumber % 2 = 0 AS rev, l_linenumber = 7 AS dup, l_tax >= 0.08 AS failed, l_quantity > 2 AS proper, CAST(l_quantity AS BIGINT) AS q, l_linenumber % 3 AS shape,
  CAST(l_quantity AS BIGINT) + CASE WHEN l_linenumber % 3 = 2 THEN 3 ELSE 0 END AS len,
  substring(repeat('ACGT', 16), CAST((l_partkey + l_linenumber) % 4 + 1 AS INT), CAST(l_quantity AS INT) + CASE WHEN l_linenumber % 3 = 1 THEN 2 ELSE 0 END) AS seq,
  CASE WHEN l_suppkey % 3 = 0 THEN 'chr1' END AS mate_ref, CASE WHEN l_suppkey % 3 = 0 THEN l_suppkey * 8 END AS mate_pos FROM lineitem)"""

CHROMOSOME = "'^(chr)?(X|Y|([12]?[0-9]))$'"

SITES = """sites AS (SELECT p_partkey, 'v' || p_partkey AS id, 'chr' || (p_partkey % 22 + 1) AS reference_name, p_partkey * 8 + 3 AS start, p_partkey * 8 + 3 + CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 1 END AS "end",
  substring('ACGT', p_size % 4 + 1, 1) || CASE WHEN p_partkey % 7 = 0 THEN 'A' ELSE '' END AS reference_bases,
  CASE WHEN p_partkey % 11 = 0 THEN [substring('ACGT', (p_size + 1) % 4 + 1, 1), substring('ACGT', (p_size + 2) % 4 + 1, 1)] ELSE [substring('ACGT', (p_size + 1) % 4 + 1, 1)] END AS alts,
  CASE WHEN p_partkey % 13 = 0 THEN 0.0 ELSE p_retailprice END AS quality, p_partkey % 9 AS f, (p_size % 50 + 0.5) / 51 AS af, p_partkey % 7 <> 0 AS snp, p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AS single FROM part)"""

CALLS = """calls AS (SELECT l_partkey, n_name, CAST(min(l_linenumber) % 3 - 1 AS INT) AS g1, CAST(max(CAST(l_quantity AS INT)) % 2 AS INT) AS g2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""

SEGMENTS = "segs AS (SELECT o_orderkey, 'chr' || (o_custkey % 22 + 1) AS reference_name, o_custkey * 10 AS s, o_custkey * 10 + 50 + o_orderkey % 2000 AS e, 'B' || o_orderkey AS name, CAST(o_orderkey % 2 AS INT) - 1 AS g FROM orders)"

MEANS = f"""parts AS (SELECT reference_name, rgs, CASE WHEN mq < 10 THEN 'L' WHEN mq < 30 THEN 'M' ELSE 'H' END AS mq, position, position + len AS stop,
  unnest(generate_series(position - position % {WIDTH}, position + len - 1 - (position + len - 1) % {WIDTH}, {WIDTH})) AS bucket FROM reads WHERE reference_name <> '*' AND len > 0),
sums AS (SELECT reference_name, bucket, rgs, m AS mq, CAST(sum(least(bucket + {WIDTH}, stop) - greatest(bucket, position)) AS DOUBLE) / {WIDTH} AS mean FROM (SELECT *, unnest([mq, 'A']) AS m FROM parts) GROUP BY ALL)"""

QUANTILE_ROWS = "SELECT reference_name, bucket, mq, " + ", ".join(f"l[CAST(greatest(floor(({q} * len(l) - 1) / {QUANTILES - 1}.0), 0) AS INT) + 1] AS q{q}" for q in range(QUANTILES)) + " FROM (SELECT reference_name, bucket, mq, list(mean ORDER BY mean) AS l FROM sums GROUP BY ALL)"

BASES = f"""usable AS (SELECT * FROM reads WHERE regexp_matches(reference_name, {CHROMOSOME}) AND NOT failed AND NOT dup AND proper),
bases AS (SELECT replace(reference_name, 'chr', '') AS reference_name, rev, 10 + l_linenumber AS quality, substring(seq, CAST(i + CASE WHEN shape = 1 THEN 2 ELSE 0 END AS INT) + 1, 1) AS base,
  position + i + CASE WHEN shape = 2 AND i >= q // 2 THEN 3 ELSE 0 END AS position FROM (SELECT *, unnest(generate_series(0, q - 1)) AS i FROM usable))"""

FREQUENCIES = "freq AS (SELECT replace(reference_name, 'chr', '') AS reference_name, start AS position, reference_bases AS ref_base, alts[1] AS alt_base, af AS ref_freq FROM sites WHERE f NOT IN (0, 1) AND quality <> 0 AND single AND af >= 0.01 AND 1 - af >= 0.01)"

PILES = """seen AS (SELECT reference_name, position, base AS letter, quality, count(*) AS k FROM bases GROUP BY ALL),
piles AS (SELECT reference_name, position, ref_freq, base, quality, CAST(coalesce(sum(k), 0) AS BIGINT) AS n FROM (SELECT f.reference_name, f.position, ref_freq, quality, k,
  CASE WHEN letter IS NULL THEN NULL WHEN letter = ref_base THEN 'REF' WHEN letter = alt_base THEN 'NONREF' ELSE 'OTHER' END AS base FROM freq f LEFT JOIN seen USING (reference_name, position)) GROUP BY ALL)"""


def _share(key: str) -> str:
    high, low = f"CAST('0x' || substring(md5({key}), 1, 8) AS BIGINT)", f"CAST('0x' || substring(md5({key}), 9, 8) AS BIGINT)"
    signed = f"((CASE WHEN {high} >= 2147483648 THEN {high} - 4294967296 ELSE {high} END) * 4294967296 + {low})"
    return f"(1.0 - CAST({signed} AS DOUBLE) / 9223372036854775808.0) * 0.5"


def _likelihood(alpha: float) -> str:
    table = [(1.0, 0.0, 0.0), (0.0, 1 / 3, 2 / 3), (0.5, 0.5, 0.0), (1 / 6, 1 / 6, 2 / 3), (0.0, 1.0, 0.0), (1 / 3, 0.0, 2 / 3)]
    err = "pow(10.0, -quality / 10.0)"
    pick = lambda r: f"CASE base WHEN 'REF' THEN CAST({r[0]!r} AS DOUBLE) WHEN 'NONREF' THEN CAST({r[1]!r} AS DOUBLE) ELSE CAST({r[2]!r} AS DOUBLE) END"
    chance = [f"((1 - {err}) * {pick(table[2 * g])} + {err} * {pick(table[2 * g + 1])})" for g in range(3)]
    ks = [(i, j) for i in range(3) for j in range(3)]
    sums = ", ".join(f"sum(CASE WHEN base IS NULL THEN 0.0 ELSE n * ln({1 - alpha} * {chance[i]} + {alpha} * {chance[j]}) END) AS l{i}{j}" for i, j in ks)
    prior = ["ref_freq * ref_freq", "ref_freq * (1 - ref_freq)", "(1 - ref_freq) * (1 - ref_freq)"]
    terms = [f"(ln({prior[i]}) + ln({prior[j]}) + l{i}{j})" for i, j in ks]
    top = f"greatest({', '.join(terms)})"
    return f"SELECT CAST({alpha} AS DOUBLE) AS alpha, round(sum({top} + ln({' + '.join(f'exp({t} - {top})' for t in terms)})), 4) AS log_likelihood FROM (SELECT reference_name, position, ref_freq, {sums} FROM piles GROUP BY ALL)"


def _w(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"


IBS = """c AS (SELECT l_partkey AS v, n_name AS s, g1, g2 FROM calls JOIN sites ON p_partkey = l_partkey WHERE single),
m AS (SELECT v, sum((g1 = 0)::INT + (g2 = 0)::INT) >= sum((g1 > 0)::INT + (g2 > 0)::INT) AS major FROM c GROUP BY v),
k AS (SELECT c.*, CASE WHEN major THEN g1 > 0 OR g2 > 0 ELSE g1 = 0 OR g2 = 0 END AS minor FROM c JOIN m USING (v) WHERE g1 >= 0 OR g2 >= 0)"""

SITE_LINES = """site_lines AS (SELECT CASE p_partkey % 6 WHEN 0 THEN 'chr' || (p_partkey % 22 + 1) || ',' || p_partkey * 8 || ',' || (p_partkey * 8 + 200) WHEN 1 THEN '  chr' || (p_partkey % 22 + 1) || '  ' || p_partkey * 8 || '    ' || (p_partkey * 8 + 100) || ' '
  WHEN 2 THEN 'GL.' || p_partkey || ':' || p_partkey * 8 || ':' || (p_partkey * 8 + 50) WHEN 3 THEN 'X,' || p_partkey || ',' || (p_partkey + 9) || ',foo,bar' WHEN 4 THEN 'track name=' || p_brand ELSE '' END AS value FROM part),
contigs AS (SELECT g[1] AS reference_name, CAST(g[2] AS BIGINT) AS start, CAST(g[3] AS BIGINT) AS "end" FROM (SELECT [regexp_extract(value, r, 1), regexp_extract(value, r, 2), regexp_extract(value, r, 3)] AS g FROM site_lines, (SELECT '^\\s*([\\w\\.]+)\\W+(\\d+)\\W+(\\d+).*$' AS r)) WHERE g[1] <> '')"""

MERGED = """pts AS (SELECT s.id, s.reference_name, s.start, s."end", snp, count(n_name) AS own, coalesce(string_agg(n_name, ',' ORDER BY n_name), '') AS own_names FROM sites s LEFT JOIN calls ON l_partkey = p_partkey GROUP BY ALL),
added AS (SELECT id, count(*) AS extra, string_agg(g.name, ',' ORDER BY s, e, g.name) AS names FROM pts JOIN segs g ON g.reference_name = pts.reference_name AND s <= start AND start < e WHERE snp GROUP BY id)"""

ALLELES = "alleles AS (SELECT reference_name, replace(reference_name, 'chr', '') AS canonical, start, \"end\", id AS variant_id, unnest(list_concat(alts, [reference_bases])) AS allele FROM sites WHERE snp)"
KNOWN = "known AS (SELECT replace(reference_name, 'chr', '') AS canonical, start, \"end\", alts[1] AS allele, 'k' || (p_partkey % 17) AS gene_id FROM sites WHERE p_partkey % 3 = 0)"
EXACT = "exact AS (SELECT reference_name, start, allele, variant_id, gene_id FROM alleles JOIN known USING (canonical, start, \"end\", allele))"
EFFECT = """exons AS (SELECT 't' || s_suppkey AS transcript_id, 'g' || (s_suppkey % 40) AS gene_id, CAST(s_suppkey % 22 + 1 AS VARCHAR) AS canonical, s_suppkey * 160 AS ts, s_suppkey % 2 = 1 AS rev, substring(repeat('ACTTGGGTCAC', 180), CAST(s_suppkey % 11 + 1 AS INT), 1800) AS bases,
  s_suppkey * 160 + 30 AS cs, s_suppkey * 160 + 1700 AS ce, s_suppkey * 160 + x.a AS es, s_suppkey * 160 + x.b AS ee, CASE x.n WHEN 0 THEN s_suppkey % 3 WHEN 1 THEN CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE (s_suppkey + 1) % 3 END END AS frame
  FROM supplier, (VALUES (0, 10, 800), (1, 900, 1750)) x(n, a, b) WHERE s_suppkey % 10 <> 9),
code AS (SELECT * FROM (SELECT substring('TCAG', CAST(i // 16 + 1 AS INT), 1) || substring('TCAG', CAST(i // 4 % 4 + 1 AS INT), 1) || substring('TCAG', CAST(i % 4 + 1 AS INT), 1) AS codon, substring('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(i + 1 AS INT), 1) AS aa FROM range(64) t(i))),
hits AS (SELECT a.*, e.*, CASE WHEN rev THEN ee - start - 1 ELSE start - es END AS off, CASE WHEN rev THEN reverse(translate(substring(bases, CAST(es - ts + 1 AS INT), CAST(ee - es AS INT)), 'ACGT', 'TGCA')) ELSE substring(bases, CAST(es - ts + 1 AS INT), CAST(ee - es AS INT)) END AS sq
  FROM alleles a JOIN exons e ON a.canonical = e.canonical AND es <= start AND start < ee AND cs <= start AND start < ce WHERE frame IS NOT NULL),
cod AS (SELECT *, (off + frame) % 3 AS w, off - (off + frame) % 3 AS c FROM hits),
ch AS (SELECT *, substring(sq, CAST(c + 1 AS INT), 3) AS f, substring(substring(sq, CAST(c + 1 AS INT), 3), 1, CAST(w AS INT)) || CASE WHEN rev THEN translate(allele, 'ACGT', 'TGCA') ELSE allele END || substring(substring(sq, CAST(c + 1 AS INT), 3), CAST(w + 2 AS INT), 3) AS t FROM cod WHERE c >= 0 AND ee - es > c + 3),
eff AS (SELECT reference_name, start, allele, variant_id, CASE WHEN b.aa = '*' THEN 'STOP_GAIN' WHEN a.aa = '*' THEN 'STOP_LOSS' ELSE 'NONSYNONYMOUS_SNP' END AS effect, gene_id, transcript_id FROM ch JOIN code a ON a.codon = f JOIN code b ON b.codon = t WHERE a.aa <> b.aa)"""

_names = ", ".join(f"'{n}'" for n in FRIENDS)

ORACLES: dict[str, str] = {
    "count_reads": _w(READS) + "SELECT count(*) AS n_reads FROM reads WHERE reference_name <> '*'",
    "count_reads_region": _w(READS) + f"SELECT count(*) FILTER (position >= {REGION[1]} AND position < {REGION[2]}) AS strict, count(*) FILTER (position < {REGION[2]} AND position + len > {REGION[1]}) AS overlapping FROM reads WHERE reference_name = '{REGION[0]}'",
    "count_by_read_group_set": _w(READS) + "SELECT rgs AS read_group_set_id, count(*) AS n_reads, count(*) FILTER (reference_name = '*') AS n_unmapped FROM reads GROUP BY 1",
    "coverage_means": _w(READS, MEANS) + "SELECT reference_name, bucket, rgs AS read_group_set_id, mq, mean FROM sums",
    "coverage_quantiles": _w(READS, MEANS) + QUANTILE_ROWS,
    "coverage_annotations": _w(READS, MEANS, f"qs AS ({QUANTILE_ROWS})") + f"SELECT reference_name, bucket AS start, bucket + {WIDTH} AS \"end\", count(*) AS n_classes, max(floor(q{QUANTILES - 1} * 1e6 + 0.5) / 1e6) FILTER (mq = 'A') AS most FROM qs GROUP BY 1, 2",
    "read_filters": _w(READS) + f"SELECT count(*) FILTER (regexp_matches(reference_name, {CHROMOSOME})) AS on_chromosome, count(*) FILTER (NOT failed) AS not_failed, count(*) FILTER (NOT dup) AS not_duplicate, count(*) FILTER (proper) AS proper, count(*) FILTER (reference_name = '*') AS unmapped, count(*) FILTER (mq < 10) AS low, count(*) FILTER (mq >= 10 AND mq < 30) AS middle, CAST(sum(len) AS BIGINT) AS covered FROM reads",
    "read_shards": _w(READS) + f"SELECT CASE WHEN reference_name <> '*' THEN reference_name ELSE coalesce(mate_ref, '*') END AS shard_reference, CASE WHEN reference_name <> '*' THEN position - position % {LOCI} WHEN mate_ref IS NOT NULL THEN mate_pos - mate_pos % {LOCI} ELSE 0 END AS shard_start, count(*) AS n_reads FROM reads GROUP BY 1, 2",
    "reads_table": _w(READS) + "SELECT id, fragment_name, rgs AS read_group_set_id, nullif(reference_name, '*') AS reference_name, CASE WHEN reference_name <> '*' THEN position END AS position, CASE WHEN reference_name <> '*' THEN mq END AS mapping_quality, CASE WHEN reference_name = '*' THEN NULL WHEN shape = 0 THEN '1x' || q WHEN shape = 1 THEN '3x2,1x' || q ELSE '1x' || (q // 2) || ',4x3,1x' || (q - q // 2) END AS cigar, CAST(length(seq) AS BIGINT) AS n_qualities FROM reads",
    "cigar_walk": _w(READS, BASES) + "SELECT reference_name, base, count(*) AS n, CAST(sum(position) AS BIGINT) AS positions, CAST(sum(quality) AS BIGINT) AS qualities FROM bases GROUP BY 1, 2",
    "sites_parse": _w(SITE_LINES) + "SELECT * FROM contigs",
    "variant_filters": _w(SITES) + f"SELECT id, f NOT IN (0, 1) AS passing, regexp_matches(reference_name, {CHROMOSOME}) AS on_chromosome, quality <> 0 AS not_low_quality, snp, single AS single_snp FROM sites",
    "private_variants": _w(SITES, CALLS) + f"SELECT id, reference_name, start, \"end\", reference_bases, array_to_string(alts, ',') AS alternates FROM sites WHERE p_partkey IN (SELECT l_partkey FROM calls) AND p_partkey NOT IN (SELECT l_partkey FROM calls WHERE n_name NOT IN ({_names}))",
    "delete_variants": _w(SITES) + "SELECT id, reference_name, start FROM sites s WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p_size % 5 = 0 AND s.id = 'v' || p.p_partkey)",
    "deleted_count": "SELECT count(*) AS n_deleted FROM part WHERE p_size % 5 = 0",
    "ibs_minor": _w(SITES, CALLS, IBS) + "SELECT a.s AS s1, b.s AS s2, floor(sum((a.minor AND b.minor)::INT) / count(*) * 1e6 + 0.5) / 1e6 AS score, CAST(sum((a.minor AND b.minor)::INT) AS DOUBLE) AS total, count(*) AS n FROM k a JOIN k b ON a.v = b.v AND a.s < b.s GROUP BY 1, 2",
    "ibs_ratio": _w(SITES, CALLS, IBS) + "SELECT a.s AS s1, b.s AS s2, floor(sum(((a.g1 = b.g1)::INT + (a.g2 = b.g2)::INT) / 2.0) / count(*) * 1e6 + 0.5) / 1e6 AS score, CAST(sum(((a.g1 = b.g1)::INT + (a.g2 = b.g2)::INT) / 2.0) AS DOUBLE) AS total, count(*) AS n FROM k a JOIN k b ON a.v = b.v AND a.s < b.s GROUP BY 1, 2",
    "shared_variant_pairs": _w(CALLS) + "SELECT a.n_name AS s1, b.n_name AS s2, count(*) AS n FROM calls a JOIN calls b ON a.l_partkey = b.l_partkey AND a.n_name <= b.n_name WHERE a.l_partkey IN (SELECT p_partkey FROM part) AND (a.g1 > 0 OR a.g2 > 0) AND (b.g1 > 0 OR b.g2 > 0) GROUP BY 1, 2",
    "gvcf_merge": _w(SITES, CALLS, SEGMENTS, MERGED) + "SELECT id, reference_name, start, own + coalesce(extra, 0) AS n_calls, md5(CASE WHEN names IS NULL THEN own_names WHEN own = 0 THEN names ELSE own_names || ',' || names END) AS calls_md5 FROM pts LEFT JOIN added USING (id)",
    "gvcf_merge_sites": _w(SITES, CALLS, SEGMENTS, SITE_LINES, MERGED) + "SELECT id, reference_name, start, own + coalesce(extra, 0) AS n_calls FROM pts LEFT JOIN added USING (id) WHERE EXISTS (SELECT 1 FROM contigs c WHERE c.reference_name = pts.reference_name AND c.start < pts.\"end\" AND pts.start < c.\"end\")",
    "allele_frequencies": _w(SITES, FREQUENCIES) + "SELECT reference_name, position, ref_base, alt_base, floor(ref_freq * 1e6 + 0.5) / 1e6 AS ref_freq FROM freq",
    "sampled_positions": _w(READS, BASES) + f"SELECT reference_name, count(*) AS n, count(DISTINCT position) AS n_positions FROM bases WHERE {_share('reference_name || chr(58) || position || chr(58) || rev')} < 0.25 GROUP BY 1",
    "pileup": _w(READS, BASES, SITES, FREQUENCIES, PILES) + "SELECT reference_name, position, base, CAST(quality AS BIGINT) AS quality, n FROM piles",
    "contamination_log_likelihood": _w(READS, BASES, SITES, FREQUENCIES, PILES) + " UNION ALL ".join(_likelihood(a) for a in ALPHAS),
    "annotate_exact": _w(SITES, ALLELES, KNOWN, EXACT) + "SELECT * FROM exact",
    "annotate_effect": _w(SITES, ALLELES, EFFECT) + "SELECT * FROM eff",
    "annotate_variants": _w(SITES, ALLELES, KNOWN, EXACT, EFFECT) + "SELECT concat_ws(':', reference_name, start, allele, variant_id) AS key, count(*) AS n, string_agg(e, ',' ORDER BY e) AS effects FROM (SELECT reference_name, start, allele, variant_id, 'KNOWN:' || gene_id AS e FROM exact UNION ALL SELECT reference_name, start, allele, variant_id, effect || ':' || gene_id FROM eff) GROUP BY 1",
    "bam_round_trip": _w(READS) + "SELECT id, CAST(CASE WHEN proper THEN 2 ELSE 0 END + CASE WHEN rev THEN 16 ELSE 0 END + CASE WHEN failed THEN 512 ELSE 0 END + CASE WHEN dup THEN 1024 ELSE 0 END + CASE WHEN reference_name = '*' THEN 4 ELSE 0 END AS BIGINT) AS flag, reference_name, CAST(CASE WHEN reference_name = '*' THEN 0 ELSE position + 1 END AS BIGINT) AS pos, CASE WHEN reference_name = '*' THEN 0 ELSE mq END AS mapping_quality, CASE WHEN reference_name = '*' THEN '*' WHEN shape = 0 THEN q || 'M' WHEN shape = 1 THEN '2S' || q || 'M' ELSE (q // 2) || 'M3D' || (q - q // 2) || 'M' END AS cigar, coalesce(mate_ref, '*') AS mate_reference_name, CAST(coalesce(mate_pos + 1, 0) AS BIGINT) AS mate_pos, seq, repeat(chr(CAST(43 + l_linenumber AS INT)), CAST(q + CASE WHEN shape = 1 THEN 2 ELSE 0 END AS INT)) AS qual, 'RG:Z:' || rgs AS tags FROM reads",
    "bam_diff": _w(READS, "a AS (SELECT *, row_number() OVER (PARTITION BY reference_name, position, id ORDER BY mq, seq) AS n FROM reads)", "b AS (SELECT reference_name, position, id, mq2 AS mq, seq, row_number() OVER (PARTITION BY reference_name, position, id ORDER BY mq2, seq) AS n FROM (SELECT *, mq + CASE WHEN position % 50 = 0 THEN 1 ELSE 0 END AS mq2 FROM reads WHERE NOT dup))") + "SELECT status, count(*) AS n FROM (SELECT CASE WHEN b.id IS NULL THEN 'first only' WHEN a.id IS NULL THEN 'second only' WHEN a.mq <> b.mq OR a.seq <> b.seq THEN 'different' END AS status FROM a FULL JOIN b USING (reference_name, position, id, n)) WHERE status IS NOT NULL GROUP BY 1",
    "event_buckets": "SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS bucket, event_type, count(*) AS n, min(value) AS least, max(value) AS most FROM events GROUP BY 1, 2",
}

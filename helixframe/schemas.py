"""The logical schemas of reads, variants and annotations."""

POSITION = "struct<reference_name: string, position: bigint, reverse_strand: boolean>"
CIGAR = "array<struct<operation: string, operation_length: bigint, reference_sequence: string>>"
CALLS = "array<struct<call_set_id: string, call_set_name: string, genotype: array<int>>>"

READS = f"""
id string, read_group_id string, read_group_set_id string, fragment_name string, proper_placement boolean,
duplicate_fragment boolean, fragment_length bigint, read_number bigint, number_reads bigint, failed_vendor_quality_checks boolean,
alignment struct<position: {POSITION}, mapping_quality: bigint, cigar: {CIGAR}>,
secondary_alignment boolean, supplementary_alignment boolean, aligned_sequence string, aligned_quality array<bigint>,
next_mate_position {POSITION}
"""

VARIANTS = f"""
id string, reference_name string, start bigint, end bigint, reference_bases string, alternate_bases array<string>,
quality double, filter array<string>, info map<string, array<string>>, calls {CALLS}
"""

ANNOTATIONS = """
id string, annotation_set_id string, reference_id string, reference_name string, start bigint, end bigint,
reverse_strand boolean, type string,
variant struct<alternate_bases: string, type: string, effect: string, gene_id: string, transcript_ids: array<string>>,
transcript struct<gene_id: string, coding_sequence: struct<start: bigint, end: bigint>, exons: array<struct<start: bigint, end: bigint, frame: int>>>,
info map<string, array<string>>
"""

#: Cigar operations: name, letter of the text form, integer stored in the warehouse table. Fixed values of the formats.
CIGAR_OPERATIONS = [
    ("ALIGNMENT_MATCH", "M", 1),
    ("CLIP_HARD", "H", 2),
    ("CLIP_SOFT", "S", 3),
    ("DELETE", "D", 4),
    ("INSERT", "I", 5),
    ("PAD", "P", 6),
    ("SEQUENCE_MATCH", "=", 7),
    ("SEQUENCE_MISMATCH", "X", 8),
    ("SKIP", "N", 9),
]
LETTER = {name: letter for name, letter, _ in CIGAR_OPERATIONS}
CODE = {name: code for name, _, code in CIGAR_OPERATIONS}

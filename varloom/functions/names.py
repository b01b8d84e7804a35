"""Column names of the long table: fixed part, header-derived part, hashing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The leading columns, their types, and the other annotation
# field that travels unparsed next to the expanded one.
FIXED_COLUMNS = ("CHROM", "POS", "REF", "ALT", "QUAL", "FILTER", "AC", "AN", "AF")
FIXED_TYPES = {"POS": "bigint", "QUAL": "double", "AC": "int", "AN": "int", "AF": "double"}
CARRIED = {"CSQ": "ANN", "ANN": "CSQ"}

# Subfields of one ANN entry, in order.
ANN_COLUMNS = (
    "allele", "annotation", "annotation_impact", "gene_name", "gene_id",
    "feature_type", "feature_id", "transcript_biotype", "rank", "hgvs_c",
    "hgvs_p", "cdna_pos_cdna_length", "cds_pos_cds_length",
    "aa_pos_aa_length", "distance", "errors_warnings_info",
)

# Names a header-derived column may never take (compared in lower case, as
# Spark resolves columns without regard to case).
RESERVED_NAMES = frozenset(
    [c.lower() for c in FIXED_COLUMNS] + ["id"] + [c.lower() for c in CARRIED]
)


def sanitise_names(raw: Iterable[str], reserved: Iterable[str] = RESERVED_NAMES) -> list[str]:
    """Header subfield names as lower snake_case; repeats get ``_2``, ``_3``..."""
    taken = {name.lower() for name in reserved}
    names = []
    for text in raw:
        base = "_".join(re.findall("[0-9A-Za-z]+", text)).lower() or "field"
        name, n = base, 2
        while name in taken:
            name, n = f"{base}_{n}", n + 1
        taken.add(name)
        names.append(name)
    return names


def leading_columns(field: str = "CSQ") -> list[str]:
    """Fixed columns plus the carried field, in output order."""
    return [*FIXED_COLUMNS, *([CARRIED[field]] if field in CARRIED else [])]


def table_columns(names: Sequence[str], field: str = "CSQ") -> list[str]:
    """The column list of one converted file, as its schema hash sees it."""
    return [*leading_columns(field), *names]


def columns_md5(names: Column) -> Column:
    """md5 of an array of names written one per line."""
    return F.md5(F.concat(F.array_join(names, "\n"), F.lit("\n")))

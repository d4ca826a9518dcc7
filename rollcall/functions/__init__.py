"""Column functions: cleansing, labels, file-name classification."""

from rollcall.functions.cleanse import (  # noqa: F401
    TFS,
    TFS_NA,
    TFS_NA_STAR,
    clean_decimal,
    clean_double,
    clean_int,
    composite_key,
    first_present,
    merge_columns,
    strip_decimal_suffix,
    strip_zero_fraction,
    suppress,
    typed_null,
    unparsed,
)
from rollcall.functions.labels import (  # noqa: F401
    classify_sat_format,
    derive_detail_level,
    fiscal_to_school_year,
    fiscal_year,
    split_dropout_label,
    split_graduation_label,
    split_label,
    subgroup_category,
    year_end,
    year_start,
)
from rollcall.functions.report_types import base_pattern, classify_report_type  # noqa: F401

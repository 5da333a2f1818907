from cdcspark.plans.mapping import (
    captured_columns,
    load_mapping,
    load_table_list,
    mapped_tables,
    mapping_verdict,
    pairs_verdict,
    parse_mapping,
    parse_pairs,
    parse_table_list,
    project_mapped,
    source_tables,
    table_columns,
    table_list_verdict,
)
from cdcspark.plans.schema import declared_type, describe, ensure_sync_column, spark_type, translate_schema, translate_types

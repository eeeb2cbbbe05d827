from basketry.sources.readers import (  # noqa: F401
    BUSINESS_SCHEMA,
    INTERACTION_SCHEMA,
    REVIEW_SCHEMA,
    parse_json_column,
    read_businesses,
    read_interactions_csv,
    read_json_lines,
    read_reviews,
    read_table,
)

from dimloom.functions.columns import (  # noqa: F401
    fill_default,
    json_field,
    nested_field,
    org_name,
    org_type,
    period_text,
)

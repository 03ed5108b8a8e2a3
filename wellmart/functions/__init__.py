from wellmart.functions.semantics import (  # noqa: F401
    add_months_ts,
    any_not_null,
    ci,
    eq_ci,
    first_non_empty,
    guarded_ratio,
    in_ci,
    is_blank,
    isnull,
    label_if_total,
    like_ci,
    month_boundaries,
    ne_ci,
    non_empty,
    not_in_ci,
    not_like_ci,
    null_if_ci,
    null_outside,
    typed_null,
    varchar,
    xml_escape,
)

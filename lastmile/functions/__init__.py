from lastmile.functions.columns import (  # noqa: F401
    decimal_point,
    flag,
    guarded_corr,
    known_text,
    numeric,
    numeric_text,
    parsed,
    peak_hour,
    safe_ratio,
    strip_accents,
    strip_space,
    text_form,
    text_key,
)

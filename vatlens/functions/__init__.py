from vatlens.functions.expr import (  # noqa: F401
    clamp_min, dbl, decimals_to_double, least_of, money_text, nz, prior_period,
    prior_period_int, product_abs_one_minus, safe_div,
)

from propensa.functions.exprs import (
    epoch_us, exact_mean, exact_std, exact_sum, fold_of, parse_prop, parse_props, safe_div,
    std_of, ts_lit, units, unscaled,
)

__all__ = [
    "epoch_us", "exact_mean", "exact_std", "exact_sum", "fold_of", "parse_prop", "parse_props",
    "safe_div", "std_of", "ts_lit", "units", "unscaled",
]

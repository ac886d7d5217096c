from kinrank.functions.formulas import (deviation, out, predict_from, rank_key,
                                       safe_ratio, scale)

__all__ = ["deviation", "out", "predict_from", "rank_key", "safe_ratio", "scale"]

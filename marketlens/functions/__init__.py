from marketlens.functions.safe_math import (
    register_safe_math,
    safe_div,
    safe_exp,
    safe_ln,
    safe_pow,
    safe_sqrt,
)

__all__ = ["register_safe_math", "safe_div", "safe_exp", "safe_ln", "safe_pow", "safe_sqrt"]

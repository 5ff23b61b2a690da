"""Column expressions: seeded draws, chat templates, whitespace tokens."""

from dialforge.functions.draw import (  # noqa: F401
    bucket_of, draw_key, pick_from_array, pick_index, u, u_py, u_sql,
)

from kinrank.sources.readers import (read_personal, read_ratings, read_titles,
                                     write_lines, write_ratings)
from kinrank.sources.schema import ITEM, RATING, RATINGS_SCHEMA, USER

__all__ = ["ITEM", "RATING", "RATINGS_SCHEMA", "USER", "read_personal", "read_ratings",
           "read_titles", "write_lines", "write_ratings"]

"""DataFrame to DataFrame operators, usable with ``df.transform``."""

"""DataFrame operators: decode, as-of association, normalisation, positions."""

"""DataFrame operators: record shaping, bundling, parameters, calls."""

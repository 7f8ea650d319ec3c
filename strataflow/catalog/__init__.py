"""The registered queries: test tables mapped to the layers, jobs on them, and matching SQL."""

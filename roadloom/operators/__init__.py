"""Network preparation, observations, events, bottlenecks, rankings: each a function of DataFrames."""

"""The models: dimensions, fact, reports and the jobs that build them."""

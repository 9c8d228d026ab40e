"""End-to-end jobs: features, forecast, back-test, feature search, model training."""

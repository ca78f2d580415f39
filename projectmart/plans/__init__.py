"""Silver and gold tables, features, model, reports and the run order."""

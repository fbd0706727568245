"""Named outputs: feature tables, model dataset, star schema, analytic view."""

"""Jobs built from the operators: layers, views, metrics, the whole run."""

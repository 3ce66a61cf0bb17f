"""DataFrame -> DataFrame operators: steps, write modes, layout, audits."""

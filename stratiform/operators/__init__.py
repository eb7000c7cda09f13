"""DataFrame operators: columns, quality, description, scaling, clustering, evaluation."""

"""Source recipes and the mixtures built from them."""

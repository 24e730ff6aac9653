"""Plan building blocks that hold up under skew."""

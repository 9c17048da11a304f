"""Plan building blocks: sizes, axes, spines, step lists."""

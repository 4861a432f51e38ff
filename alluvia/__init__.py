"""Event-linked basin analytics and text preparation as lazy Spark operators."""

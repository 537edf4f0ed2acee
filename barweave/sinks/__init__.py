"""Writers. Each can be repeated safely with the same input."""

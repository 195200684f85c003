"""What only streaming needs: runners and stateful processors."""

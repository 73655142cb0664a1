"""Golden ingredient lines: (line, cleaned, volume, weight, count); None = not fixed."""

LINES = [
    ("100ml of milk", None, 0.4227, None, None),
    ("100 milliliters of milk", None, 0.4227, None, None),
    ("3 tspn of sugar", None, 0.0625, None, None),
    ("1 table spoon sugar", None, 0.0625, None, None),
    ("1 tbsp sugar", None, 0.0625, None, None),
    ("1 spoonful sugar", None, 0.0625, None, None),
    ("1 fluid oz milk", None, 0.125, None, None),
    ("1 cup of milk", "milk", 1.0, None, None),
    ("1C of milk", "milk", 1.0, None, None),
    ("1 pint of milk", None, 2.0, None, None),
    ("1 qt of milk", None, 4.0, None, None),
    ("1L of milk", None, 4.2268, None, None),
    ("1 liter of milk", None, 4.2268, None, None),
    ("1 gallon of milk", None, 16.0, None, None),
    ("1 gram of sugar", None, None, 1.0, None),
    ("1g. sugar", None, None, 1.0, None),
    ("1 ounce of butter", None, None, 28.34, None),
    ("1oz. of butter", None, None, 28.34, None),
    ("1 stick of butter", None, None, 113.4, None),
    ("1 pound of butter", None, None, 453.59, None),
    ("1 lb of butter", None, None, 453.59, None),
    ("1 kg of butter", None, None, 1000.0, None),
    ("1 kilo of butter", None, None, 1000.0, None),
    ("1kilo gram of butter", None, None, 1000.0, None),
    ("Two or three cups milk", None, 2.5, None, None),
    ("A spoonful or two of sesame seeds", "sesame seed", 0.0938, None, None),
    ("One fourth cups milk", None, 0.25, None, None),
    ("One and a fourth cups milk", None, 1.25, None, None),
    ("⅕ cups milk", None, 0.2, None, None),
    ("1 ½c. flour", "flour", 1.5, None, None),
    ("One and a half c flour", "flour", 1.5, None, None),
    ("1 1/2 cups flour", "flour", 1.5, None, None),
    ("1 1/2 pound chicken breast", "chicken", None, 226.795, None),
    ("One half-lb chicken breast", "chicken", None, 226.795, None),
    ("8oz chicken breast", "chicken", None, 226.72, None),
    ("Pinch of salt", "salt", None, 3.0, None),
    ("2 pinches salt", None, None, 6.0, None),
    ("A few pinches of salt", None, None, 9.0, None),
    ("A generous drizzle of balsamic vinegar", "balsamic vinegar", None, 3.0, None),
    ("5 sticks of butter", "butter", None, 567.0, None),
    ("4 1/2in thick slices country white bread", "white bread", None, 120.0, None),
    ("8 garlic cloves, peeled and sliced paper thin", "garlic", None, 40.0, None),
    ("8 large garlic cloves, peeled and sliced paper thin", "garlic", None, 40.0, None),
    ("8 cloves of garlic", "garlic", None, 40.0, None),
    ("1/2 garlic clove, smashed and very finely chopped", "garlic", None, 2.5, None),
    ("1/2 teaspoon ground cloves", "clove", None, None, None),
    ("2 whole cloves", "clove", None, 1.0, None),
    ("3 onion", None, None, None, 3.0),
    ("4 to 5 cups/0.9 kilos to 1.1 kg all-purpose flour", "flour", 4.5, 1000.0, None),
    ("10 cups sugar (2.2 kilos)", "sugar", 10.0, 2200.0, None),
    ("1 1/5 cup/11fl oz/300ml heavy cream", "heavy cream", 1.2, None, None),
    ("2 cups, 10 ounces, shredded Monterey Jack", "monterey jack", 2.0, 283.4, None),
    ("2 100 gram cans milk", None, None, 200.0, None),
    ("2 1/2 cups milk", None, 2.5, None, None),
    ("3 2 1/2 gram nuts", None, None, 7.5, None),
    ("3 (100 gram) bags flour", "flour", None, 300.0, None),
    ("1/2 (200-gram) can black beans", "black bean", None, 100.0, None),
    ("1 1/2 (200g) cans black beans", "black bean", None, 300.0, None),
    ("3 bags flour, about 100 grams each", None, None, 300.0, None),
    ("1/3 cup plus 1 tablespoon extra-virgin olive oil", "olive oil", 0.3958, None, None),
    ("2 100 gram cans of milk", "milk", None, None, None),
    ("2 sticks of melted softened butter", "butter", None, None, None),
    ("2 cups finely chopped shallots", "shallot", None, None, None),
    ("1 large low -fat, high-fiber, burrito-size tortilla", "tortilla", None, None, None),
    ("2 cups ready-to-serve creamy tomato soup", "tomato soup", None, None, None),
    ("2 cups no-salt-added fat-added thick-cut potato chips", "potato chip", None, None, None),
    ("2 cups all-in-one oven-to-table potato chips", "potato chip", None, None, None),
    ("1 tbsp coconut oil for frying", "coconut oil", None, None, None),
    ("1/2 cup vegetable oil for frying, or as needed", "vegetable oil", None, None, None),
    ("1 cup high-quality mustard such as colemans", "mustard", None, None, None),
    ("1 cup high-quality mustard like colemans", "mustard", None, None, None),
    ("1 cup Crisco® vegetable shortening", "vegetable shortening", None, None, None),
    ("1 cup Coleman's mustard", "mustard", None, None, None),
    ("1/2 pound skinned and boned smoked trout", "smoked trout", None, None, None),
    ("1 cup european butter available at specialty stores", "butter", None, None, None),
    ("3 cups peeled, cored, and thickly sliced apples", "apple", None, None, None),
    ("1 cup sliced and firmly packed, ripe banana", "banana", None, None, None),
    ("2 cups flour", "flour", 2.0, 360.0, None),
    ("2 firmly packed cups flour", "flour", 2.4, None, None),
    ("2 scant cups flour", "flour", 1.8, None, None),
    ("2 onions", "onion", None, 240.0, 2.0),
    ("2 large onions", "onion", None, None, 2.4),
    ("2 very small onions", "onion", None, None, 1.6),
    ("2 sticks butter, each 5000 grams", None, None, 226.8, None),
    ("6 skinless, boneless chicken breasts (10 ounces each)", "chicken", None, 1700.4, None),
    ("2 lbs kohlrabies (about 5 medium)", "kohlraby", None, 907.18, None),
    ("1 3-1/2 to 4 pound pork shoulder", "pork", None, 1700.9625, None),
    ("1 cup plus 2 tablespoons (9 oz / 255 g) lukewarm water", "water", 1.125, 255.0, None),
    ("1/3 cup plus 1 1/2 cups grated Parmesan", "parmesan", 1.8333, None, None),
    ("2 pounds plus 1/2 cup grated Parmesan", None, 0.5, 907.18, None),
    ("1 4 1/2-to 5-pound whole turkey breast", "turkey", None, 2154.5525, None),
    ("1/2 pound sliced, thick-deli-cut or rotisserie turkey breast, chopped", "turkey", None, None, None),
    ("3 (15.1/2-ounce) cans kidney or pinto beans", "pinto bean", None, None, None),
    ("1 cup red, orange/yellow, or green bell peppers", "green bell pepper", None, None, None),
    ("8 ounces fresh morel mushrooms, halved if large, or 1 ounce dried morels", "morel mushroom", None, None, None),
    ("1 whole side of salmon, or 4 (6-ounce) salmon fillets", "salmon", None, 680.16, None),
    ("10 fresh sage leaves, or 1/2 teaspoon dried sage", "sage", None, 30.0, None),
    ("2 or 3 sprigs mint, regular or spicy", "mint", None, None, 2.5),
    ("1 pint grape tomatoes, or sweet 100 tomatoes or pear tomatoes", "grape tomato", 2.0, None, None),
    ("1 jalapeno pepper, seeded and diced, or to taste", "jalapeno pepper", None, None, None),
    ("1/4 cup natural cane sugar or packed organic light brown sugar", "light brown sugar", None, None, None),
    ("1 cup heavy or whipping cream", "whipping cream", None, None, None),
    ("5 egg whites plus 2 egg yolks", "egg", None, 190.0, None),
    ("2 cups onions", "onion", 2.0, 360.0, None),
    ("200 grams onion", "onion", None, 200.0, None),
]
